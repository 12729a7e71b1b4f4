"""Operators that prepare, clean and measure training text."""
