"""Analytics jobs on Spark: SQL-style queries, statistics, feature tables, models."""
