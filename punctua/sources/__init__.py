"""Readers, writers and SQL access."""
