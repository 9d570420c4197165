"""Registered queries, each with its plain DuckDB counterpart where SQL can express it."""
