"""Structured Streaming delivery of the snapshot feed."""
