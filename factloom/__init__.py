"""Filing-facts analytics on Spark: JSON documents in, star schema and reports out."""
