"""Streaming sinks, query starts and progress."""
