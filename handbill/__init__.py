"""Spark-native analytics over semi-structured event records."""
