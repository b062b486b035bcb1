"""Column expressions: text, keys, dates, geometry and rates."""
