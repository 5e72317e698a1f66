"""Delivery operators: clean, check, profile, keep history, reconcile."""
