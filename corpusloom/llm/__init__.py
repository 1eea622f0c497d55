"""Operators for preparing training data at scale, each on its own.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.

Rules shared by all operators, unless a docstring says otherwise: a null text
is an empty text; texts are processed whole; input columns are kept, and a result
column takes the place of an input column of the same name; an empty table gives
an empty result with the same columns.
"""
