"""Column expressions and value rules shared by the operators."""
