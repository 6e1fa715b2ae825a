"""Spark-native journey analytics."""
