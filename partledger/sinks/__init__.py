"""Writers: archived data and control tables."""
