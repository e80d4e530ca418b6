"""Spark-native analytics for sports-statistics data."""
