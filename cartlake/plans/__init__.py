"""Whole jobs: what a schedule would call, from sources to sinks."""
