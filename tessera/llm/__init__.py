"""Operators for large training-data pipelines.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Each
module holds one operator with a general interface; ``queries.py`` applies
them to the given tables with production parameters.
"""
