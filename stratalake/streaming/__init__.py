"""Loading raw rows as they arrive."""
