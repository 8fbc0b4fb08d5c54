"""DataFrame-to-DataFrame operators; every column name is a parameter."""
