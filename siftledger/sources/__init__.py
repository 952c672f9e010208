"""Readers of transaction feeds."""
