"""Column expressions: text, number, date and pattern helpers."""
