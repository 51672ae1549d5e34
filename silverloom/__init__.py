"""Spark-native medallion engine over annotated image data."""
