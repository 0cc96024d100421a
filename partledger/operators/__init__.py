"""Operators over control tables and archived data."""
