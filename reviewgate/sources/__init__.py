"""Readers, writers, fixture views and artifact checks."""
