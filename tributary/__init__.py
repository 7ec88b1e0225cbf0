"""Spark-native data mapping and analytics engine."""
