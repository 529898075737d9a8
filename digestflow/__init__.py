"""Digestflow: Spark-native record linkage, ranking and text processing for news feeds."""
