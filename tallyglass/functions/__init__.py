"""Column-to-Column scalar functions."""
