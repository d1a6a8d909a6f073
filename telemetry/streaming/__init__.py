"""Structured Streaming: topic sources/sinks and the alert and archive jobs."""
