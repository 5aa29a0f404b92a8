"""Incremental loads from arriving files."""
