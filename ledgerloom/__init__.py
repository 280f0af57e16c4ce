"""Multi-tenant operations analytics as Spark DataFrame jobs."""
