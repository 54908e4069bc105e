"""Training-data operators: dedup, decontamination, packing, tokens, quality, models."""
