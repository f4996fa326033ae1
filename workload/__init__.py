"""Registered queries: inputs derived from the given tables, and the SQL each is checked with."""
