"""Security-event analytics as composable Spark DataFrame operators."""
