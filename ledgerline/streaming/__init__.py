"""Incremental form of the file load."""
