"""Readers, writers, table management and the adapter for the supplied tables."""
