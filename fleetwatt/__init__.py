"""Fleet telemetry analytics on Spark: operators from DataFrame to DataFrame."""
