"""Operators for preparing training data at scale.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
