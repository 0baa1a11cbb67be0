"""Spark-native aggregation of sale listings: extract, enrich, deduplicate, query."""
