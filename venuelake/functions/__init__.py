"""Column functions: everything here stays in native Spark expressions."""
