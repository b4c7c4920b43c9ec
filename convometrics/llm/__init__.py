"""Operators for preparing training data, one module each.

Nothing outside this folder, ``corpus_pipeline.py`` and ``__spark_entry__.py``
refers to it.
"""
