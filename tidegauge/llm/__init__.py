"""Operators for preparing text and vectors for training."""
