"""Spark-native tabular analytics: ranking of paired contests and tracking of catalog prices."""
