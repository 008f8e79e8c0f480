"""Registered queries grouped by operator family; each sits next to its oracle."""
