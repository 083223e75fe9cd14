"""Column expressions: cleaning, conforming and calendar functions."""
