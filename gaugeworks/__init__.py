"""Spark-native engine for building, checking and publishing indicator tables."""
