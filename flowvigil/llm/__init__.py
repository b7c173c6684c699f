"""Operators for training-data pipelines over documents, pages and vectors.

Nothing else in the library imports this subpackage.
"""
