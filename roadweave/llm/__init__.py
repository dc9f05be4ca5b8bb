"""Operators on documents and pages for training-data pipelines."""
