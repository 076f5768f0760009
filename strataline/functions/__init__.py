"""Column-level functions; everything here is a built-in Spark expression."""
