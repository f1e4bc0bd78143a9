"""Incremental loads as file-source streams."""
