"""Structured Streaming: incremental append of the landing folder into bronze."""
