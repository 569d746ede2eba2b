"""Queries of this subpackage and the SQL each must agree with, where SQL can express it."""

from __future__ import annotations

from quire.llm import (
    bpe, html_text, language_model, licences, neighbours, ngram_join, packing, periodic, personal, quality, secrets,
    suffixes, whitening,
)

_MODULES = (packing, licences, bpe, quality, personal, ngram_join, suffixes, language_model, secrets, neighbours,
            periodic, html_text, whitening)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
