"""Readers, writers and lookups."""
