"""Registered queries: each Spark query beside its DuckDB twin."""
