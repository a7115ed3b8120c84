"""Functions of the cascade."""
