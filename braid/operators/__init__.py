"""Name binding, query run, output writing."""
