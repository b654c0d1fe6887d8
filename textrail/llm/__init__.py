"""Training-data operators: dedup, scoring, encoding, search and packing."""
