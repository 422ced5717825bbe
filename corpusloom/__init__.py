"""Spark-first engine for semi-structured document corpora."""

__version__ = "0.1.0"
