"""Writers for files and tables."""
