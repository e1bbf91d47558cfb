"""Scheduled micro-batches as Structured Streaming runs."""
