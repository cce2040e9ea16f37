"""Column -> Column builders, all of them plain Spark expressions."""
