"""Readers and constant relations."""
