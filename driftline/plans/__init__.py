"""Composed jobs, registered queries and their DuckDB oracle SQL."""
