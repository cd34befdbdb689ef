"""Column functions: JSON feature rules as built-in Spark expressions."""
