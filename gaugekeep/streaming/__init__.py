"""Structured Streaming form of the realtime update."""
