"""Catalog, listing parsers and readers."""
