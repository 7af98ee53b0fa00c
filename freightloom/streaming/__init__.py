"""Live state kept by Structured Streaming."""
