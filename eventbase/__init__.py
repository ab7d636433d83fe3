"""Keyed JSON event ingest, query and analysis on Spark."""
