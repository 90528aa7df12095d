"""Column-level expressions. Nothing here runs Python per row."""
