"""Table and stream operators on the public PySpark DataFrame, SQL and Structured Streaming API."""
