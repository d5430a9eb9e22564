"""Training-data operators: deduplication, filtering, mixing, search, encoding."""
