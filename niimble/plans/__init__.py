"""Operators chained into complete runs."""
