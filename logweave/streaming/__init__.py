"""Structured Streaming: staged log runs, sinks, metrics."""
