"""Commerce event and order warehouse on Spark: logs and row changes in, reports out."""
