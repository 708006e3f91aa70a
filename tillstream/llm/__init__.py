"""Training-data operators: near duplicates, decontamination, sharding, packing, formatting, scoring, extraction."""
