"""Operators for the preparation of training data; nothing else in the library imports them."""
