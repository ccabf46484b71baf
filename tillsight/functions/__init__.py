"""Column functions; every one is a composition of Spark built-ins."""
