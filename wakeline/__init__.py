"""wakeline: ship position-report (AIS) analytics as Spark DataFrame and Structured Streaming jobs."""
