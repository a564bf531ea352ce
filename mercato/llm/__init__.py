"""Operators of a training-data pipeline, each built by its own named method.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
