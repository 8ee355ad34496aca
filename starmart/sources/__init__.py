"""Readers: delimited text, GeoJSON, catalog registration, landing-path derivation."""
