"""Column expressions: type mapping, value coercion, names and paths."""
