"""Composed plans: star schema, key figures and reports."""
