"""Document analytics on PySpark."""
