"""Operators of the cascade."""
