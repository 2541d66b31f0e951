"""Queries over the driver tables, by area; each beside its SQL."""
