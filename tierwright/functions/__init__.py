"""Column expressions: built-in functions only, no Python UDFs."""
