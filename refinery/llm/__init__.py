"""Operators for preparing training text: ten operators and their queries.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
