"""Readers, writers and table profiles."""
