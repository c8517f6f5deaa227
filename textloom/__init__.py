"""Spark jobs that prepare multilingual text and code for language-model training."""

__version__ = "0.1.0"
