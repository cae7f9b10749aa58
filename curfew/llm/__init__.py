"""Operators on text for building training data."""
