"""Transaction-risk analytics expressed as Spark DataFrame jobs."""
