"""Structured Streaming form of the incremental build."""
