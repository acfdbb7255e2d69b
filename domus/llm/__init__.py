"""Operators of a training-data pipeline: mixing, substring dedup, secret scans, toxicity, near-dedup,
page text, chat formatting, vector dedup, benchmark decontamination and web archives.

Nothing else in the library imports this package; ``queries.py`` registers its queries.
"""
