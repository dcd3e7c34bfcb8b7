"""Operators of a large-scale training-data pipeline.

One module per operator (``url_filter``, ``ngram_join``, ...); ``queries`` holds
the thin registered queries and their SQL. Nothing outside this subpackage
imports it.
"""
