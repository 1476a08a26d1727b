"""Operators of a training-data pipeline; nothing else in the library uses them."""
