"""Operators for training corpora: sharding, scoring, duplicates, quality, packing, search."""
