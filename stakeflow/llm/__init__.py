"""Operators of a training-data pipeline: token counts, extraction, quality, dedup, decontamination, formatting."""
