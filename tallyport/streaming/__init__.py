"""Deliveries and change files that arrive as files over time."""
