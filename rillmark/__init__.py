"""Climate and water anomaly analytics as Spark DataFrame jobs."""
