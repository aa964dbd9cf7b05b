"""Structured Streaming runners around the batch functions."""
