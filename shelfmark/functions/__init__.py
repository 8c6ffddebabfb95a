"""Column expressions. Everything here is native Spark: no Python runs in tasks."""
