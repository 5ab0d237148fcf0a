"""Operators of a training-data pipeline: mixing, scoring, near and line duplicates, personal data, toxicity, shards, search, media, tokens."""
