"""Column-to-column functions."""
