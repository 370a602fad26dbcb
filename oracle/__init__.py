"""Equivalent SQL for each registered query, for checking results in another engine."""
