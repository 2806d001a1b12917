"""Operators and queries for large text corpora; nothing outside this package needs them."""
