"""DataFrame operators the extracts are composed of."""
