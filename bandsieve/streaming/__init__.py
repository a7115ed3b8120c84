"""Streaming of the cascade."""
