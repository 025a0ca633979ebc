"""Operators of a training-data pipeline (secret, URL, licence and quality
filters, de-duplication, decontamination, token counts, packing, sharding)."""
