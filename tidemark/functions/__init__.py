"""Column expressions: log fields, hash fractions, lists packed in strings."""
