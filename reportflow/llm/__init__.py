"""Training-data operators: language ID, deduplication, privacy, mixing, tokenisation, search and scoring.

Every operator takes and returns DataFrames. Nothing outside this subpackage imports it, apart from the
guarded registration in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
