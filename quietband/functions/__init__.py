"""Column functions: every one is a native expression, none is a Python UDF."""
