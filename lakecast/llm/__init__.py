"""Operators for large training corpora. Nothing outside this folder and ``corpus_pipeline`` imports it."""
