"""Column expressions: text, time, cleaning rules and the Python UDF forms."""
