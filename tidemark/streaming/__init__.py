"""Structured Streaming: replicate a stream of changes, consume the event stream."""
