"""Readers: archived data, source listings, control documents and raw files."""
