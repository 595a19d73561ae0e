"""Readers, writers, file listings and audit counts."""
