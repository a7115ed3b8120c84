"""Spark-native confidence-cascade analytics."""
