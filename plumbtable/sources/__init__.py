"""Readers, writers and persisted state."""
