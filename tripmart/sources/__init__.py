"""Scans: parquet zones, link pages and the list of landed objects."""
