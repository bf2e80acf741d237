"""Spark-native medallion data platform: landing, trusted and exploitation zones."""
