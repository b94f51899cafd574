"""Training-data operators: scoring, classification, search, packing, deduplication and mixing."""
