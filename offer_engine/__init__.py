"""Campaign analytics on customer interaction logs, as Spark DataFrame jobs."""
