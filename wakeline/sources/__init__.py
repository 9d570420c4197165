"""Readers: day files, tables, stream payloads, incremental reads."""
