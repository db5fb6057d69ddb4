"""Operators for preparing training data: dedup, filtering, tokens, packing, search.

Nothing else in the library imports this subpackage; its driver queries are
in ``queries.py`` and the corpus pipeline in ``corpus_pipeline.py`` at the
repository top.
"""
