"""Plans of the cascade."""
