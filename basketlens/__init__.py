"""Consumer and basket analytics as lazy Spark DataFrame jobs."""
