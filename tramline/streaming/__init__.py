"""Structured Streaming forms of the minute average and the snapshot history."""
