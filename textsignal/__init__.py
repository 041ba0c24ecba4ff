"""Text-signal analytics as plain Spark DataFrame, SQL, MLlib and streaming jobs."""
