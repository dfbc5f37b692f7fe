"""Scans: scrape documents, file listings, tables."""
