"""Operators of a training-data pipeline: documents in, decisions, texts and token ids out."""
