"""Operators put together into runs."""
