"""Operators of a large-scale training-data pipeline.

Nothing outside this package imports it; ``queries.py`` registers one thin
query per operator and ``corpus_pipeline.py`` (repository top) chains five
of them.
"""
