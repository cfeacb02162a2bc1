"""Operators of a training-data pipeline over web documents; nothing else in the library imports this package."""
