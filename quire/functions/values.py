"""Column helpers: text to number, JSON text to arrays, and the labels the analyses group by."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cover hosts and the label each is reported under; the first match wins.
COVER_HOSTS = {
    "archive.org": "Internet Archive",
    "openlibrary.org": "Open Library",
    "isbndb.com": "ISBNdb",
}

_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_SPECIAL = r"(?i)^[+-]?(inf|infinity|nan)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _stripped(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def try_int(c: Column | str) -> Column:
    """Text to INTEGER or NULL; decimals and exponents round half away from zero (``'1999.7'`` is 2000).

    Plain digits, which is nearly every row, take the first branch and never touch the number pattern.
    """
    c = _col(c)
    text = _stripped(c)
    number = F.when(text.rlike(_NUMBER), F.regexp_replace(text, "_", "").try_cast("double"))
    return F.when(c.rlike(_INTEGER), c.try_cast("int")).otherwise(F.round(number, 0).try_cast("int"))


def try_float(c: Column | str) -> Column:
    """Text to 32-bit FLOAT or NULL. Suffixes such as ``5f`` that a bare cast would take are NULL."""
    c = _col(c)
    text = _stripped(c)
    return (
        F.when(c.rlike(_INTEGER), c.try_cast("float"))
        .when(text.rlike(_NUMBER), F.regexp_replace(text, "_", "").try_cast("float"))
        .when(text.rlike(_SPECIAL), text.try_cast("float"))
    )


def try_double(c: Column | str) -> Column:
    """Text to DOUBLE or NULL, as JSON writes numbers and by their names; suffixes such as ``5f`` are NULL."""
    c = _col(c)
    return F.when(c.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$") | c.rlike(_SPECIAL), c.try_cast("double"))


def round2(c: Column | str) -> Column:
    """Two decimals, rounding the scaled binary value (so 1.005 gives 1.0, not 1.01)."""
    return F.round(_col(c).cast("double") * 100, 0) / 100


def text_length(c: Column | str) -> Column:
    """Length in code points as BIGINT."""
    return F.char_length(_col(c)).cast("bigint")


def size_mb(c: Column | str) -> Column:
    """Byte count as text to MiB as FLOAT; dividing by a power of two is exact."""
    return (try_float(c) / F.lit(1024 * 1024)).cast("float")


def json_strings(c: Column | str, strict: bool = True) -> Column:
    """JSON array text to ``array<string>``. A text that is not exactly one JSON array is an error; with
    ``strict=False`` it is NULL, and :func:`unreadable_list` tells."""
    c = _col(c)
    # Inside brackets, text after the array is an error instead of being ignored.
    whole = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<array<string>>", {"mode": "PERMISSIVE"})
    entries = F.when(F.size(whole) == 1, F.get(whole, F.lit(0)))
    if not strict:
        return entries
    wrong = F.raise_error(F.concat(F.lit("not a JSON array: "), F.substring(c, 1, 200)))
    return F.when(c.isNull() | entries.isNotNull(), entries).otherwise(wrong.cast("array<string>"))


def unreadable_list(c: Column | str) -> Column:
    """Is a text there, but no JSON array?"""
    c = _col(c)
    return c.isNotNull() & json_strings(c, strict=False).isNull()


def first_language(c: Column | str) -> Column:
    """First entry of list-shaped text, or the text itself when it is not list-shaped."""
    c = _col(c)
    return F.when(c.like("[%]"), F.regexp_extract(c, r'^\["([^"]*)"', 1)).otherwise(c)


def cover_source(c: Column | str, hosts: Mapping[str, str] = COVER_HOSTS, other: str = "Other") -> Column:
    """Label of the first host contained in a cover URL."""
    c = _col(c)
    label: Column | None = None
    for host, name in hosts.items():
        hit = c.contains(host)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return F.lit(other) if label is None else label.otherwise(other)


def rarity(holdings: Column, marker: str = "many") -> Column:
    """'Rare' for a non-empty JSON array that nowhere holds ``marker`` as a string value.

    ``holdings`` is normalised JSON text (the output of ``get_json_object`` or ``from_json``). The pattern
    takes the marker only as a whole value: what follows it is a comma or a closing bracket, never a colon,
    so object keys do not count, at any nesting depth.
    """
    held = r'(^|[\[,:])\s*"' + re.escape(marker) + r'"\s*([,\]}]|$)'
    n = F.coalesce(F.json_array_length(holdings), F.lit(0))
    return F.when((n > 0) & ~holdings.rlike(held), "Rare").otherwise("Not Rare")
