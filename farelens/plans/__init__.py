"""Composed plans: plot datasets and the named query catalog."""
