"""segue: collection analytics and continuation as Spark DataFrame jobs."""
