"""One module per registered query: the query and, where it exists, its SQL."""
