"""Relational operators over entries, documents and cases."""
