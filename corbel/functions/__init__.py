"""Column expressions: predicates, dates, text, arrays and struct paths."""
