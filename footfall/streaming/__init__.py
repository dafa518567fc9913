"""Event feed on Structured Streaming."""
