"""Column functions: time keys, text, row keys and the METRIC cell."""
