"""Operators for training-data pipelines (mixing, dedup, tokenising, filtering, archives)."""
