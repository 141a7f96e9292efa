"""Registered queries: each entry pairs a Spark builder with its DuckDB oracle SQL."""
