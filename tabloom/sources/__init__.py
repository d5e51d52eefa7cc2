"""Readers, writers and adapters from the test tables."""
