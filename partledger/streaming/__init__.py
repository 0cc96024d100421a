"""Incremental runs of the same operators over arriving listings and data."""
