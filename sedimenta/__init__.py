"""Spark-native engine for dated, evidence-backed name records."""
