"""Registered checks: each query on views of the given tables, next to the SQL that must agree with it."""
