"""Column expressions: null tokens, lenient casts, epochs, flags, predicates."""
