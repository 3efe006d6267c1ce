"""Readers, seeds and the table store."""
