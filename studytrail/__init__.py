"""Analytics operators for learning-platform logs on DataFrames and Structured Streaming."""
