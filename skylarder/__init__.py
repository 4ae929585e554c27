"""Weather-aware meal recommendation lake, expressed as Spark DataFrame jobs."""
