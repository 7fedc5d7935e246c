"""Brand-mention and complaint analytics as Spark DataFrame transforms."""
