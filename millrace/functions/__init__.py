"""Column functions: they take and return Spark columns."""
