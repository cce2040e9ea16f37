"""Reading and writing archives and capture tables."""
