"""Whole jobs: train, evaluate, score."""
