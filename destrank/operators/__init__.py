"""DataFrame -> DataFrame operators of the ranking pipeline."""
