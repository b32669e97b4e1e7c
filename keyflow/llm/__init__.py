"""Operators of a training-data pipeline: tokens, near copies, secrets, archives, search, mixing, shards, toxicity."""
