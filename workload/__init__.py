"""Queries over the driver's tables: one per operator, each with an independent SQL."""
