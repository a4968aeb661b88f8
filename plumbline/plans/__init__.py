"""Composite profiles and the end-to-end jobs."""
