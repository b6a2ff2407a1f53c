"""Operators for large training-data pipelines.

Each module holds one operator; ``queries`` holds the registered queries and
their SQL. Nothing outside this subpackage (and ``corpus_pipeline.py``)
imports it.
"""
