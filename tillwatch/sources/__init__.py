"""Readers, writers and file bookkeeping."""
