"""Catalog reads, value profiling, MDL documents and the document store."""
