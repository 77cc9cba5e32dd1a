"""Column expressions and aggregate registry."""
