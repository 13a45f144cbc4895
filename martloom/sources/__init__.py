"""Readers, as-of snapshot filters and discovery."""
