"""Opinion analytics over social-media text, written as PySpark DataFrame jobs."""
