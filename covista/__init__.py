"""Spark-native engine for entity/item membership data: co-occurrence, directory,
publishing, incremental state and snapshot operators."""

__version__ = "0.1.0"
