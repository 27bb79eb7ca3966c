"""Column functions: everything here is a row-local expression (no shuffle)."""
