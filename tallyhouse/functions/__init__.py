"""Column expressions: text, dates, numbers, categories, registered SQL functions."""
