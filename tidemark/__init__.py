"""Panel time-series analytics as PySpark DataFrame jobs."""
