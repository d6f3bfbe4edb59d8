"""Column expressions: text, labels, arrays and rounding."""
