"""Operators of a training-data pipeline over the documents, labels and benchmark tables."""
