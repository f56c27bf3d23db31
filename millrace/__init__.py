"""Spark-native analytics over nested, time-annotated corpora."""
