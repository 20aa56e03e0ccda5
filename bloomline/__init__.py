"""bloomline: phenology and climate analytics as Spark DataFrame jobs."""
