"""Operators for preparing training text: dedup, decontamination, scoring, mixing, extraction, packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
