"""Operators for training-data pipelines over documents, labels, benchmark items and vectors."""
