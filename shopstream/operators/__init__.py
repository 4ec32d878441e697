"""Building blocks between the raw files and the gold tables."""
