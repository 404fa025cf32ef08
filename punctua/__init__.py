"""Service-reliability analytics for scheduled transport, written as Spark DataFrame jobs."""
