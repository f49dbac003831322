"""Column expressions and calendar helpers."""
