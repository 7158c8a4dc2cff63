"""Operators of a training-data pipeline: licences, archives, vector search, near copies, tokens."""
