"""Operators for large text corpora: privacy, packing, decontamination, deduplication, scoring, search, extraction."""
