"""Registered queries over the driver's tables, and SQL that computes the same."""
