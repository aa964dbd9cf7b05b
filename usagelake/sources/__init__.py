"""Readers, writers and file classification."""
