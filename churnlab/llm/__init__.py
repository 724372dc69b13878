"""Training-data operators: dedup, decontamination, scoring, packing, sharding, search."""
