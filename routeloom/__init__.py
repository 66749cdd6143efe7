"""Spark-native delay and disruption analytics."""
