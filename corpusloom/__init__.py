"""Spark-native annotation, planning and quality analytics for sentence corpora."""
