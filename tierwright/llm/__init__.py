"""Operators of a training-data pipeline: text, pairs, layout and chat."""
