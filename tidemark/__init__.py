"""Snapshot, change-capture, cleansing and export work as Spark DataFrames."""
