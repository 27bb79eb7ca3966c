"""Declared corpus specs and the registered queries with their SQL twins."""
