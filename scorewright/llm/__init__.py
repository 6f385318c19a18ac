"""Operators for large text corpora: cleaning, near duplicates, search, tokens and packing."""
