"""Column expressions: missing values and scalar functions."""
