"""Column expressions and schema predicates."""
