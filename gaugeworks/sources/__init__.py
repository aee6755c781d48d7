"""Readers, writers and the shared folder."""
