"""Entity anomaly analytics on PySpark."""
