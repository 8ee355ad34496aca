"""Structured Streaming: incremental, exactly-once load of landed daily files."""
