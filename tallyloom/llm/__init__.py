"""Operators over a training corpus; nothing else in the library imports this package."""
