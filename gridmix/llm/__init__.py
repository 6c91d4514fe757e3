"""Operators for preparing training text at corpus scale.

Nothing outside this package imports it.  Each module holds one operator; ``queries`` registers one
``opN_<name>`` query per operator and the corpus pipeline's stages are in ``corpus_pipeline.py``.
"""
