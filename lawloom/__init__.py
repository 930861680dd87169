"""Spark-native engine for registers of law and for large text corpora."""
