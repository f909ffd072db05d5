"""Event analytics as DataFrame operators for batch and Structured Streaming."""
