"""Layer jobs."""
