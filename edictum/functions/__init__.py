"""Column expressions: text, URLs, dates."""
