"""Operators of a training-data pipeline: deduplication, extraction, tokens, quality, privacy."""
