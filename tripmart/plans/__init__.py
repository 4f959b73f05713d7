"""Whole runs: from the landing zone to published tables, and reports on tables."""
