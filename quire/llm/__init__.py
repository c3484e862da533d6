"""Training-data operators: deduplication, tokens, packing, language, mixing, secrets, personal data."""
