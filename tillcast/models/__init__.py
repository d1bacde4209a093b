"""Regression models on feature vectors and the model registry."""
