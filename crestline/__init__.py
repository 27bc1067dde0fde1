"""Peak-load analytics on Spark."""
