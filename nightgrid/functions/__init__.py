"""Column expressions.  None of them uses a Python UDF."""
