"""Listing queries, statistics and the refresh job."""
