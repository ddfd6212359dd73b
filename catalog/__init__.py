"""Queries over the sample tables and their DuckDB counterparts."""
