"""Column expressions and window specs shared by the operators."""
