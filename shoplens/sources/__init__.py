"""Readers, writers and the adapters from the given tables to domain frames."""
