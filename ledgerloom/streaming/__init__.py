"""Incremental marts and the Structured Streaming job that feeds them."""
