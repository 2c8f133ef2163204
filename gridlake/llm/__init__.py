"""Operators of a training-data pipeline over documents, embeddings and pages.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
