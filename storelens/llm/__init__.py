"""Operators for building training corpora: extraction, filtering, deduplication, scoring and packing."""
