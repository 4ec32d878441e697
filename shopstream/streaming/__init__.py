"""The pipeline on unbounded input."""
