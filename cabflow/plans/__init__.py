"""The jobs."""
