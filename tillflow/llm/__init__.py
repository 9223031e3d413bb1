"""Corpus operators for training-data pipelines.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries, and each module holds one operator with its own interface.
"""
