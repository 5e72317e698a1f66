"""Contract-driven data deliveries as Spark DataFrame, SQL and Structured Streaming jobs."""
