"""Operators for training corpora, their queries and SQL."""
