"""Layered (raw, typed, star) table building on Spark DataFrames."""

__version__ = "0.1.0"
