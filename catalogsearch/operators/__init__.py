"""Operators from MDL tables to documents, search results and DDL text."""
