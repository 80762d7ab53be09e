"""Card-fraud analytics and a feature store as plain Spark jobs."""
