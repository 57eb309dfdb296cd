"""Operators of a training-data pipeline: filtering, deduplication, packing, tokenizing, extraction and scoring."""
