"""Structured Streaming: sources, parsing, bronze append, scoring, keyed state."""
