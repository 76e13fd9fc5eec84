"""Smart-meter analytics written as Spark DataFrame jobs."""
