"""Column expressions: coercion, predicates, labels, geography."""
