"""Model-operations analytics as Spark DataFrame jobs."""
