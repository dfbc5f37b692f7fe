"""Writes: documents, tables, frequencies, archives."""
