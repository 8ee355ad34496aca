"""DataFrame -> DataFrame operators. Column names are always parameters."""
