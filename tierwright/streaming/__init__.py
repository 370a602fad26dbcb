"""Structured Streaming: per-account balances and most recent transactions."""
