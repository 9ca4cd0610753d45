"""Column expressions: calendar parts, payday/season functions, metrics."""
