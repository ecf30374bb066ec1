"""Composed views and runs."""
