"""Column expressions and the one vectorised UDF."""
