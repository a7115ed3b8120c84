"""Sources of the cascade."""
