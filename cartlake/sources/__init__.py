"""Batch and stream readers; every one has an explicit schema."""
