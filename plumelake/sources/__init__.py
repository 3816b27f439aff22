"""Schemas, readers, writers and table registration."""
