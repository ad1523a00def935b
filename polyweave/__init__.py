"""Spark-native analytics for multilingual corpora."""
