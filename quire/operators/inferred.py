"""Records of unknown shape to typed columns: the schema is an aggregate of one scan, the projection casts to it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "__record"


def parsed_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """``lines`` with each as a VARIANT in ``__record``; NULL where a line is not exactly one JSON value."""
    boxed = F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit("]")))
    alone = F.try_variant_get(boxed, "$[1]", "variant").isNull()
    return lines.withColumn(RECORD, F.when(alone, F.try_variant_get(boxed, "$[0]", "variant")))


def record_type(records: DataFrame) -> T.StructType:
    """The columns that fit all records: one for each top-level key, nested objects as structs.

    A key whose values differ in kind, an object without keys, and an object whose keys differ in case only are JSON
    text. No columns at all if not all records are objects: :func:`typed` then gives whole records as text.
    """
    found = records.agg(F.schema_of_variant_agg(RECORD)).first()[0] or "VOID"
    if not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType([])
    return _struct(found)


def _struct(text: str) -> T.StructType:
    """Schema text of an object, as Spark's variant functions write it, to a type that files can hold."""
    fields = [(name, _kind(inner)) for name, inner in _members(text[len("OBJECT<"):-1])]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _kind(text: str) -> T.DataType:
    if text.startswith("OBJECT<"):
        names = [n.lower() for n, _ in _members(text[len("OBJECT<"):-1])]
        return _struct(text) if names and len(set(names)) == len(names) else T.StringType()
    if text.startswith("ARRAY<"):
        return T.ArrayType(_kind(text[len("ARRAY<"):-1]))
    if text in ("VOID", "VARIANT"):
        return T.StringType()
    return T._parse_datatype_string(text)


def _members(text: str) -> list[tuple[str, str]]:
    """``name: type`` pairs; names with odd characters are quoted by backticks, doubled inside."""
    out, at = [], 0
    while at < len(text):
        name = re.compile(r"`((?:[^`]|``)*)`: |([^:]*): ").match(text, at)
        at = end = name.end()
        depth, quoted = 0, False
        while end < len(text) and (depth or quoted or text[end] != ","):
            if text[end] == "`":
                quoted = not quoted
            elif not quoted:
                depth += {"<": 1, "(": 1, ">": -1, ")": -1}.get(text[end], 0)
            end += 1
        out.append((name[1].replace("``", "`") if name[1] is not None else name[2], text[at:end]))
        at = end + 2
    return out


def typed(records: DataFrame, kind: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and those of :func:`record_type`, or the column ``record`` if it has none; names that differ in case only get ``__2``, ``__3``."""
    seen: dict[str, int] = {k.lower(): 1 for k in keep}
    columns: list[Column] = []
    for f in kind.fields:
        n = seen[f.name.lower()] = seen.get(f.name.lower(), 0) + 1
        name = f.name if n == 1 else f"{f.name}__{n}"
        columns.append(F.try_variant_get(RECORD, f"$[{_quoted(f.name)}]", _ddl(f.dataType)).alias(name))
    return records.select(*keep, *(columns or [F.to_json(RECORD).alias("record")]))


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def _quoted(name: str) -> str:
    """A key in a path; double quotes hold one with single quotes."""
    return f'"{name}"' if "'" in name else f"'{name}'"
