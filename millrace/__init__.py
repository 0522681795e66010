"""Spark-native data plane for grounded question-answering datasets."""
