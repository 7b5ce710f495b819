"""Column expressions. Everything here is a native Spark expression; no Python UDFs."""
