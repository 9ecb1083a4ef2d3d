"""Queries on the driver tables, one per operator, and the same results in plain SQL."""
