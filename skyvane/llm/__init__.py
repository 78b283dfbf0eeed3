"""Training-data operators: extraction, filtering, dedup, tokens, packing."""
