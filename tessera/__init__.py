"""Tessera: a Spark-native engine for evidence tables and large text corpora."""

__version__ = "0.1.0"
