"""Domain-listing analytics as composable Spark DataFrame operators."""
