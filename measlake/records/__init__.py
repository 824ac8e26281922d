"""Projections that turn joined rows into the four records."""
