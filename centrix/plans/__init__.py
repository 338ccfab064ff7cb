"""Composite plans: Lloyd training, run records, the registered query catalog."""
