"""Training-data operators: near-duplicates, fingerprints, filters, packing."""
