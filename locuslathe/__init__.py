"""Spark-native analytics over genomic intervals, sequences, reads and run records."""

__version__ = "0.1.0"
