"""Names of shredded columns.

Fixed values: these names follow from the key paths of the source records and must stay as they are,
because saved tables and saved queries use them.
"""

from __future__ import annotations

ENVELOPE_KEYS = ("_index", "_id", "_score")
SOURCE = "_source"
AAC_KEYS = ("aacid", "metadata")
METADATA = "metadata"

UNIFIED = "_source_file_unified_data"
SEARCH = "_source_search_only_fields"


def unified(name: str) -> str:
    """Column holding ``_source.file_unified_data.<name>``."""
    return f"{UNIFIED}_{name}"


def search(name: str) -> str:
    """Column holding ``_source.search_only_fields.<name>``."""
    return f"{SEARCH}_{name}"
