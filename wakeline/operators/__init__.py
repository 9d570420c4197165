"""Joins, windows, groupings and merges that the plans are put together from."""
