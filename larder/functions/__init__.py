"""Column expressions: text clean-up, list parsing, lenient casts."""
