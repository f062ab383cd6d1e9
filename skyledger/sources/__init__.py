"""Readers, fixture views, catalog and format helpers."""
