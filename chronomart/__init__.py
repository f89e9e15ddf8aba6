"""Change-data analytics on Spark: change logs, SCD Type 2 history, point-in-time facts, daily marts."""
