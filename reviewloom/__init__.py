"""Product-review analytics as Spark DataFrame jobs."""

PIPELINE_VERSION = "1.0.0"
