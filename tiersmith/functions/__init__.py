"""Column functions; all are plain Spark expressions."""
