"""helmtrack: vehicle-telemetry and trajectory analytics expressed as Spark DataFrame jobs."""
