"""Operators for large text corpora and embeddings used as training data."""
