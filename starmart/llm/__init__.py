"""Training-data operators: packing, license scans, quality rules, line, substring and
near-duplicate removal, fingerprints, a quality classifier and source mixing."""
