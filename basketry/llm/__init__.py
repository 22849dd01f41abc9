"""Operators of a training-data pipeline: packing, deduplication, licence
scans, quality, token files, embeddings, sharding and tokenisation.

``llm.catalog`` holds the registered queries and their DuckDB SQL. Nothing
outside this package (but ``corpus_pipeline.py`` and the entry module) uses it.
"""
