"""Structured Streaming form of the refresh run."""
