"""Column expressions and filter predicates."""
