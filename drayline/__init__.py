"""Spark-native operators for change capture, fleet analytics and data quality."""
