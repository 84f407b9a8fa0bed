"""Column expressions: derived values and predicates, all built-in functions."""
