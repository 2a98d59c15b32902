"""Operators for preparing language-model training data.

Nothing outside this package imports it; ``corpus_pipeline.py`` and the tests in ``tests/llm``
use it, and ``__spark_entry__.py`` adds its queries when it is present.
"""
