"""The same work on Structured Streaming."""
