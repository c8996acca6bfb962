"""Structured Streaming entry: run the delta load once per micro-batch."""
