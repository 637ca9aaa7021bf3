"""Column expressions. None of them is a Python UDF."""
