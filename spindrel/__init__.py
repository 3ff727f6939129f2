"""Spindrel: a Spark-native engine for sparse measurement matrices and their metadata."""

__version__ = "0.1.0"
