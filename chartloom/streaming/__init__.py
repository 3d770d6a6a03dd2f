"""Structured Streaming variants of scoring and of the latest-note view."""
