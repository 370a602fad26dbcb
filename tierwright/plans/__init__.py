"""Layer tables, checks and the whole run, composed from operators."""
