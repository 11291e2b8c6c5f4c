"""Column expressions: built-in Spark functions only, no Python on the row path."""
