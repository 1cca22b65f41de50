"""Structured Streaming programs."""
