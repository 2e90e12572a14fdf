"""Training-data operators: tokens, sharding, quality, scoring, near-duplicates, decontamination."""
