"""Spark-native analytics over large text corpora."""
