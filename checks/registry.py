"""All registered queries and their SQL."""

from __future__ import annotations

from checks import collection_checks, index_checks, profile_checks, storage_checks

_MODULES = (index_checks, collection_checks, profile_checks, storage_checks)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
