"""Stateless feature enrichment that also accepts a streaming DataFrame."""
