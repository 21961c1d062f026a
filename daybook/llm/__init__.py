"""Operators on training text and record linkage.  Nothing outside imports this package."""
