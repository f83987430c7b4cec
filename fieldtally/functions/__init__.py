"""Column expressions: raw cell → number, and engineered features. No Python runs per row."""
