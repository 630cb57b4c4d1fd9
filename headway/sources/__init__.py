"""Readers, writers and the small lookup tables."""
