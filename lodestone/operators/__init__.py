"""Joins, deduplication and document operators over listing DataFrames."""
