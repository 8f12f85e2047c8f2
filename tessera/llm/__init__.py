"""Training-data operators: token counts, quality, deduplication, PII, decontamination, packing, filters."""
