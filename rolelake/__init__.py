"""rolelake: job-posting analytics as Spark DataFrame jobs."""
