"""Column expressions: all built-in functions, so they stay in generated code."""
