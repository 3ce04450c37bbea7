"""Column expressions: each takes and gives Columns, none touches a DataFrame."""
