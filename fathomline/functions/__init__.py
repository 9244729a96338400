"""Column expressions: seawater formulas and text, date and JSON helpers."""
