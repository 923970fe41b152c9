"""Analytics over timestamped betting events, as Spark DataFrame and Structured Streaming operators."""
