"""Partitioned writers, manifests and table definitions."""
