"""The incremental loads as Structured Streaming queries that stop when caught up."""
