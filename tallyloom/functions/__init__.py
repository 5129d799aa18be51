"""Column expressions: Spark built-ins only, no Python UDFs."""
