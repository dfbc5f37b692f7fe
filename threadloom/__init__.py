"""Discussion-forum analytics as PySpark DataFrame jobs."""
