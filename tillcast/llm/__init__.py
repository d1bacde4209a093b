"""Operators that prepare text, pages, conversations and vectors for training language models."""
