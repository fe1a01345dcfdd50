"""Operators of a training-data pipeline: packing, scoring, deduplication, mixing, extraction, archives, sharding.

Nothing outside this subpackage imports it, apart from ``corpus_pipeline.py``
and the guarded registration in ``__spark_entry__.py``.
"""
