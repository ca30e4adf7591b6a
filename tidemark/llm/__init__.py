"""Operators of a training-data pipeline: deduplication, quality, mixing, tokens, languages, embeddings."""
