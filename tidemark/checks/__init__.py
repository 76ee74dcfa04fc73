"""Registered verification queries (Spark) and their DuckDB oracles (SQL)."""
