"""Readers of source files and layer tables."""
