"""Intentionally empty: the bookkeeping cycle is a batch process, and this library adds no streams to it."""
