"""Tidewell: a usage-event warehouse expressed as Spark DataFrame and SQL jobs."""
