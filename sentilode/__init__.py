"""Sentiment analytics for short messages as Spark DataFrame, SQL and MLlib plans."""
