"""Structured Streaming parts: sinks, keyed state, the job."""
