"""Document analytics on Spark: DataFrame and SQL operators over semi-structured documents."""
