"""Operators of a training-data pipeline: dedup, decontamination, packing, archives, extraction and scoring."""
