"""Training-data operators: near-dedup, search, classifiers, scans, extraction, tokens, shards, packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
