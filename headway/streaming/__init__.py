"""Continuous jobs over arriving messages."""
