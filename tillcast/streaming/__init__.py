"""Replaying the stream period in micro-batches."""
