"""Incremental landing: page files in, newest row per key out."""
