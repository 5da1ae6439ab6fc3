"""DataFrame transformations."""
