"""Column expressions (all built-in Spark SQL functions, no Python UDFs)."""
