"""Spark-native analytics over page-line documents."""
