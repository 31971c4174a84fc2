"""Column expressions and calendar frames."""
