"""Operators of a training-data pipeline, over tables of documents.

Each module is one operator with a general interface; ``queries`` applies them
to the given tables and derives the contract's digest columns. Nothing outside
this package (and ``corpus_pipeline``) imports it.
"""
