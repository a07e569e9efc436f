"""feedloom: content-feed analytics as Spark DataFrame jobs."""
