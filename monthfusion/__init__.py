"""Monthly area observations fused into one table, as Spark jobs."""
