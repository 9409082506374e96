"""Readers, writers and the projection of foreign tables into the raw layout."""
