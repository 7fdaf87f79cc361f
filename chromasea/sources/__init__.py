"""Readers, writers and the catalogue operators that decide what to read."""
