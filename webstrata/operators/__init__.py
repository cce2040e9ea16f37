"""DataFrame -> DataFrame operators on capture tables."""
