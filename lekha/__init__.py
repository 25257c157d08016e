"""Spark-first curation and evaluation engine for parallel script corpora."""

__version__ = "0.1.0"
