"""Column expressions; all of them are built-in JVM functions, none is a Python UDF."""
