"""Property transaction analytics on Spark."""
