"""Structured Streaming renderings of the update/commit loop."""
