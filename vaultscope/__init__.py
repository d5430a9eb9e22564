"""Event-time telemetry analytics on PySpark."""
