"""Column-expression builders (no Python per row)."""
