"""Assembly of scattered environmental observations as Spark DataFrame jobs."""
