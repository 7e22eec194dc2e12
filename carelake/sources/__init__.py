"""Readers, writers, catalog upkeep."""
