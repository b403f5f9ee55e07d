"""Operators that prepare text and names for training data. Nothing outside this package imports it."""
