"""Column builders: pure expressions, no jobs."""
