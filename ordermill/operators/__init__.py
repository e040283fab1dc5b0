"""DataFrame operators that are independent of the marketplace model."""
