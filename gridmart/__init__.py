"""Monthly electricity and climate analytics as Spark DataFrame jobs."""
