"""Ingest and refresh of JSON message feeds on Spark DataFrames."""
