"""Spark-native corpus curation and training-data engine."""
