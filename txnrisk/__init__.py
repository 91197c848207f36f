"""Spark-native customer-level financial-crime risk scoring."""
