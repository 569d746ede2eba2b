"""Nested JSON text to flat string columns.

The selected paths form a tree. Every inner node is parsed once, by one ``from_json`` that returns all its
selected children as strings; a child that has children of its own is then parsed from its own, shorter
text. A record is thus read about as many times as its fields are deep, not once per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.columns import AAC_KEYS, ENVELOPE_KEYS, METADATA, SOURCE
from quire.functions.values import try_double
from quire.operators.paths import INDEX_STEP

CORRUPT = "_corrupt_record"
DEFECTS = "_defects"
# What a good record may lose, one bit each: a score that is no number, an envelope whose body is no object, and all but
# the last value of a key that the record repeats.
DEFECT_BITS = {"lost_score": 1, "body_no_object": 2, "repeated_key": 4}
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


@dataclass(frozen=True)
class Field:
    """One column to promote: its path text, its name and where it lies."""

    path: str
    column: str
    pointer: str

    @property
    def steps(self) -> tuple[str, ...]:
        """Steps with keys unescaped; :data:`INDEX_STEP` stands for the first element."""
        return tuple(
            s if s == INDEX_STEP else s.replace("~1", "/").replace("~0", "~") for s in self.pointer[1:].split("/")
        )

    @staticmethod
    def of(path: str, column: str | None = None) -> Field:
        """From dotted path text whose keys hold neither dots nor brackets."""
        steps: list[str] = []
        for part in path.split("."):
            key, *indexes = part.split("[0]")
            steps += ([key] if key else []) + [INDEX_STEP] * len(indexes)
        escaped = [s if s == INDEX_STEP else s.replace("~", "~0").replace("/", "~1") for s in steps]
        return Field(path, column or path.translate(str.maketrans(".[]", "___")), "/" + "/".join(escaped))


class _Node:
    def __init__(self) -> None:
        self.children: dict[str, _Node] = {}
        self.columns: list[str] = []


def _tree(fields: Iterable[Field]) -> _Node:
    root = _Node()
    for f in fields:
        node = root
        for step in f.steps[1:]:
            node = node.children.setdefault(step, _Node())
        node.columns.append(f.column)
    return root


def _by_position(keys: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(len(keys))])


def _parse(text: Column, keys: Sequence[str]) -> Column:
    """JSON object text to a struct of strings named by position (keys may differ in case only)."""
    wanted = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return F.from_json(text, wanted, _STRICT).cast(_by_position(keys))


def _keys(node: _Node) -> list[str]:
    return [k for k in node.children if k != INDEX_STEP]


def extract(df: DataFrame, text: str, fields: Sequence[Field], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus one string column per field, read from the JSON object in column ``text``.

    Absent paths, JSON null and paths through a value of another kind give NULL; objects and arrays give
    their JSON text. ``text`` may also be the struct that :func:`_parse` would give for the top of the tree.
    """
    out: dict[str, str] = {}
    root = _tree(fields)
    opened = isinstance(df.schema[text].dataType, T.StructType)
    level = [(root, text)]
    df = df.select(*keep, *([] if text in keep else [text]))
    serial = 0
    while level:
        parsed: list[Column] = []
        pulled: list[Column] = []
        below: list[tuple[_Node, str]] = []
        for node, name in level:
            keys = _keys(node)
            struct = text if opened and node is root else f"__p{serial}"
            if keys and struct != text:
                parsed.append(_parse(F.col(name), keys).alias(struct))
            if INDEX_STEP in node.children:
                array = F.from_json(F.col(name), "array<string>", _STRICT)
                parsed.append(F.get(array, F.lit(0)).alias(f"__p{serial}_0"))
            for i, (step, child) in enumerate(node.children.items()):
                source = F.col(f"__p{serial}_0") if step == INDEX_STEP else F.col(struct)[f"f{keys.index(step)}"]
                child_name = f"__v{serial}_{i}"
                pulled.append(source.alias(child_name))
                out.update((c, child_name) for c in child.columns)
                if child.children:
                    below.append((child, child_name))
            serial += 1
        if pulled:
            # Two projections on purpose: the second reads fields of structs that the first has parsed.
            df = df.select("*", *parsed).select("*", *pulled).drop(*[f"__p{i}" for i in range(serial)],
                                                                   *[f"__p{i}_0" for i in range(serial)])
        level = below
    return df.select(*keep, *[F.col(out[f.column]).alias(f.column) for f in fields])


def has_defect(name: str) -> Column:
    """Does a record show a defect of :data:`DEFECT_BITS`?"""
    return F.col(DEFECTS).bitwiseAND(F.lit(DEFECT_BITS[name])) > 0


def parse_search_lines(lines: DataFrame, value: str = "value", fields: Sequence[Field] | None = None,
                       ledger: bool = False) -> DataFrame:
    """Raw search-index lines to ``_index, _id, _score, _source`` plus the bad lines in ``_corrupt_record``.

    ``_source`` stays JSON text; of a repeated key the last value counts. Blank lines vanish. With ``fields``,
    which must then be the ones handed to :func:`shred_search`, the same parse also opens ``_source``, and its
    text is never built. A score is read from a JSON number or a text that is one. ``ledger`` adds ``_defects``, what
    each good record lost (:data:`DEFECT_BITS`; zero for bad lines); repeated keys are looked for at the top level.
    """
    types = {"_index": "string", "_id": "string", "_score": "double"}
    return _parse_envelope(lines, value, types, SOURCE, fields, ledger)


def parse_aac_lines(lines: DataFrame, value: str = "value", ledger: bool = False) -> DataFrame:
    """Raw container lines to ``aacid, metadata`` (JSON text) plus ``_corrupt_record`` and, with ``ledger``, ``_defects``."""
    return _parse_envelope(lines, value, {"aacid": "string"}, METADATA, None, ledger)


def not_blank(value: str = "value") -> Column:
    """Does a line hold anything but white space? (``\\r`` is white space.)"""
    return F.col(value).rlike(r"\S")


def _parse_envelope(lines: DataFrame, value: str, types: dict[str, str], root: str,
                    fields: Sequence[Field] | None, ledger: bool) -> DataFrame:
    tree = _tree(nested_under(fields or [], root))
    keys = [] if INDEX_STEP in tree.children else _keys(tree)
    kind = T.StructType([T.StructField(k, T.StringType()) for k in keys]) if keys else T.StringType()
    record_type = T.StructType(
        [T.StructField(n, T.StringType()) for n in types] + [T.StructField(root, kind)]
    )
    # Inside brackets, text after the object or a second object is an error instead of being ignored.
    wrapped = F.concat(F.lit("["), F.col(value), F.lit("]"))
    rest = [c for c in lines.columns if c != value]
    parsed = lines.filter(not_blank(value)).select(
        *rest, value, F.from_json(wrapped, T.ArrayType(record_type), _STRICT).alias("__r")
    )
    record = F.get("__r", F.lit(0))
    good = F.coalesce((F.size("__r") == 1) & record.isNotNull(), F.lit(False))
    body = record[root].cast(_by_position(keys)) if keys else record[root]
    values = {n: record[n] if t == "string" else try_double(record[n]) for n, t in types.items()}
    columns = [*[F.when(good, v).alias(n) for n, v in values.items()], F.when(good, body).alias(root),
               F.when(~good, F.col(value)).alias(CORRUPT)]
    if ledger:
        # a body that was opened is NULL where it is missing, null or no object; only those few lines are looked at again
        wrong = body.isNull() & F.get_json_object(value, f"$.{root}").isNotNull() if keys else ~body.startswith("{")
        keys_held = F.json_object_keys(value)
        found = {"lost_score": F.greatest(*[record[n].isNotNull() & values[n].isNull() for n, t in types.items()
                                            if t != "string"], F.lit(False), F.lit(False)),
                 "body_no_object": wrong, "repeated_key": F.size(keys_held) > F.size(F.array_distinct(keys_held))}
        bits = [F.when(found[name], F.lit(bit)).otherwise(F.lit(0)) for name, bit in DEFECT_BITS.items()]
        columns.append(F.when(good, sum(bits[1:], bits[0])).otherwise(F.lit(0)).alias(DEFECTS))
    row = F.struct(*columns)
    # A generator instead of plain columns: filters on its output cannot slide below it, where Spark would
    # have to parse every line once more to evaluate them.
    return parsed.select(*rest, F.inline(F.array(row)))


def nested_under(fields: Iterable[Field], root: str) -> list[Field]:
    """Fields strictly below ``root``; other top-level keys and other roots are not shredded."""
    return [f for f in fields if len(f.steps) > 1 and f.steps[0] == root]


def shred_search(records: DataFrame, fields: Sequence[Field], keep: Sequence[str] = (),
                 keep_corrupt: bool = False) -> DataFrame:
    """X01. ``_index, _id, _score`` and one string column per selected ``_source`` path.

    ``keep_corrupt`` keeps bad lines as rows of NULLs instead of leaving them out.
    """
    rows = records if keep_corrupt else records.filter(F.col(CORRUPT).isNull())
    return extract(rows, SOURCE, nested_under(fields, SOURCE), [*keep, *ENVELOPE_KEYS])


def shred_aac(records: DataFrame, fields: Sequence[Field], keep: Sequence[str] = (),
              keep_corrupt: bool = False) -> DataFrame:
    """X02. ``aacid``, the whole ``metadata`` as JSON text and one string column per selected path."""
    rows = records if keep_corrupt else records.filter(F.col(CORRUPT).isNull())
    return extract(rows, METADATA, nested_under(fields, METADATA), [*keep, *AAC_KEYS])


def bad_files(records: DataFrame, file: str = "file_path") -> DataFrame:
    """Files holding a bad line. Spark measures them while it runs and broadcasts them only if they are few."""
    return records.filter(F.col(CORRUPT).isNotNull()).select(file).distinct()


def quarantined(records: DataFrame, mode: str = "row", file: str = "file_path") -> DataFrame:
    """S16. What to set aside: bad lines (``row``), or every row of a file that has one (``file``)."""
    if mode == "row":
        return records.filter(F.col(CORRUPT).isNotNull())
    return records.join(bad_files(records, file), file, "left_semi")


def accepted(records: DataFrame, mode: str = "row", file: str = "file_path") -> DataFrame:
    """The complement of :func:`quarantined`; in file mode a left anti join against the bad files."""
    if mode == "row":
        return records.filter(F.col(CORRUPT).isNull())
    return records.join(bad_files(records, file), file, "left_anti")
