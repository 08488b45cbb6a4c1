"""Column expressions: text, time, units, attribute parsing and string similarity."""
