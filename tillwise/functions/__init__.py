"""Column expressions; every one is a Catalyst expression, none is a Python UDF."""
