"""Operators for building training corpora: text, archives, duplicates, mixing, packing, search."""
