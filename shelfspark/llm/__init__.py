"""Operators and stages for preparing a text corpus; nothing else in the library imports this package."""
