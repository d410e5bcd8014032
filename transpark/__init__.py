"""Transpark: Spark-native mining of mobile genetic elements in assembly graphs."""
