"""Readers with fixed schemas and create-only writers."""
