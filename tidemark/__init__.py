"""Event-study analytics as plain Spark DataFrame transformations."""
