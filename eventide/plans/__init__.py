"""End-to-end jobs and the views that feed them from the given tables."""
