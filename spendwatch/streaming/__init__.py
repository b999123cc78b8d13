"""Structured Streaming form of the burst velocity rule."""
