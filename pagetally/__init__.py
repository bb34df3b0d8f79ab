"""Page-view analytics over web-server access logs, as Spark DataFrame jobs."""
