"""Column expressions: parsing, period arithmetic, classification."""
