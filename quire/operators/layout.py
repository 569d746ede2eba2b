"""How records lie in files: line statistics, parts of bounded size, compaction."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.operators.ordered import BLOCK_ROWS, running_totals
from quire.sources.files import listed_path, plain_path
from quire.sources.landing import base_name

TARGET_PART_BYTES = 10 * 1024 * 1024
TARGET_FILE_BYTES = 512 * 1024 * 1024
MOST_PARTS = 10_000
# Of one task that reads files to be merged: their rows wait in its memory for the shuffle.
MERGED_ROWS = 1_000_000
MERGED_BYTES = 32 * 1024 * 1024


def line_bytes(value: str = "value") -> Column:
    """Bytes of a line in UTF-8, with its newline."""
    return F.octet_length(value).cast("bigint") + 1


def line_stats(lines: DataFrame, by: str = "file_path", value: str = "value") -> DataFrame:
    """S07. Lines, bytes and mean bytes per line of each file, exact at any size."""
    size = line_bytes(value)
    return lines.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(size).alias("n_bytes"), F.avg(size).alias("avg_bytes_per_line")
    )


def _resized(df: DataFrame, target_bytes: int, value: str, most: int) -> tuple[DataFrame, int]:
    """Lines in evenly filled partitions, and the rows that make ``target_bytes``."""
    from quire.sources.readers import spread

    total, rows = df.agg(F.sum(line_bytes(value)), F.count(F.lit(1))).first()
    wanted = max(1, math.ceil((total or 0) / target_bytes))
    tasks = min(wanted, max(most, math.ceil((total or 0) / TARGET_PART_BYTES)))
    return spread(df, tasks), max(1, math.ceil(rows / wanted))


def resize(df: DataFrame, target_bytes: int = TARGET_PART_BYTES, value: str = "value", most: int = MOST_PARTS) -> DataFrame:
    """S06. Lines in evenly filled partitions of about ``target_bytes``; writing them gives one file each.

    Every task reports to the driver, so parts under ``TARGET_PART_BYTES`` share tasks where there would be over ``most``
    of them; :func:`write_resized` makes each a file all the same.
    """
    return _resized(df, target_bytes, value, most)[0]


def write_resized(df: DataFrame, path: str, target_bytes: int = TARGET_PART_BYTES, value: str = "value",
                  most: int = MOST_PARTS) -> None:
    """S06. Lines as text files of about ``target_bytes`` each, however many a task has to write."""
    dealt, rows = _resized(df, target_bytes, value, most)
    dealt.select(value).write.option("maxRecordsPerFile", rows).text(path)


def assign_parts(df: DataFrame, group: str, order: str, size: Column, target_bytes: int = TARGET_PART_BYTES,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """S06. Number the parts a group would be split into when cut in order at every ``target_bytes``.

    Adds ``part`` (from 1): the bytes before and including the row, minus one, over the target. The running total is
    made of narrow rows (group, order, size) in blocks (:func:`quire.operators.ordered.running_totals`), so neither a
    group nor a text has to fit anywhere; then the part joins the rows by group and order, which must be unique together.
    """
    narrow = df.select(F.col(group).alias("__g"), F.col(order).alias("__o"), size.cast("bigint").alias("__size"))
    summed = running_totals(narrow, ["__g"], [F.col("__o").asc_nulls_first()], F.col("__size"), "__total", block_rows)
    part = (F.floor((F.col("__total") - 1) / F.lit(target_bytes)) + 1).cast("bigint")
    parts = summed.select("__g", "__o", part.alias("part"))
    return df.join(parts, F.col(order).eqNullSafe(F.col("__o")) & F.col(group).eqNullSafe(F.col("__g"))).select(*df.columns, "part")


def table_root(paths: Sequence[str]) -> str:
    """The deepest directory above all files and above any ``key=value`` directory."""
    parts = [p.split("/")[:-1] for p in paths]
    common = []
    for step in zip(*parts):
        if len(set(step)) > 1 or "=" in step[0]:
            break
        common.append(step[0])
    return "/".join(common)


def partition_keys(paths: Sequence[str], root: str) -> list[str]:
    """Names of the ``key=value`` directories below ``root``, in order."""
    below = {tuple(s.split("=", 1)[0] for s in p[len(root):].split("/")[:-1] if "=" in s) for p in paths}
    if len(below) > 1:
        raise ValueError(f"files are partitioned in different ways: {sorted(below)}")
    return list(below.pop())


@dataclass(frozen=True)
class Placed:
    """An input file's share of its group's output files."""

    path: str  # as _metadata.file_path writes it
    group: str
    first: int  # the group's first output file
    count: int  # how many it has
    before: int  # bytes of the group ahead of the file
    length: int
    rows: int
    total: int  # bytes of the group


def place_files(files: Sequence[tuple[str, str, int, int]], target_bytes: int) -> tuple[list[Placed], int]:
    """Which output file each part of each input file goes to; and how many output files there are.

    ``files`` are (path, group, bytes, rows). The files of a group are laid end to end and cut into equal stretches of at
    most ``target_bytes``; a file across a cut gives its first rows to the one, its last to the next. So all output files
    of a group are of one size, but for what rows of uneven size and compression change, and few files meet in each.
    """
    groups: dict[str, list[tuple[str, int, int]]] = {}
    for path, group, length, rows in sorted(files):
        groups.setdefault(group, []).append((path, length, rows))
    out, first = [], 0
    for group, own in sorted(groups.items()):
        total = sum(n for _, n, _ in own)
        count, before = max(1, math.ceil(total / target_bytes)), 0
        for path, length, rows in own:
            out.append(Placed(path, group, first, count, before, length, rows, total))
            before += length
        first += count
    return out, first


def _slot() -> Column:
    """Output file of a row, from its place in its file and the file's in its group."""
    at = F.col("__before") + F.col("__length") * (F.col("__index") + 0.5) / F.col("__rows")
    return F.col("__first") + F.least(F.col("__count") - 1, F.floor(at * F.col("__count") / F.col("__total"))).cast("int")


def _dealt(rows: DataFrame, placed: Sequence[Placed]) -> DataFrame:
    """Rows of files with the number of their output file. The places are a row a file; the rows stay where they are."""
    places = rows.sparkSession.createDataFrame(
        [(p.path, p.group, p.first, p.count, p.before, p.length, p.rows, p.total) for p in placed],
        "__path string, __group string, __first int, __count int, __before long, __length long, __rows long, __total long")
    numbered = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    return numbered.join(F.broadcast(places), F.col("__file") == F.col("__path")).withColumn("__slot", _slot())


def compact(spark: SparkSession, files: DataFrame, target: str, target_bytes: int = TARGET_FILE_BYTES,
            by: str = "directory", mode: str = "errorifexists") -> dict[str, int]:
    """S18. Merge small Parquet files into zstd files of about ``target_bytes`` and check rows and columns.

    ``files`` is a listing (``path``, ``length``). What may be merged: with ``by="directory"`` the files of one
    directory, which is how this library writes datasets; with ``by="base"`` files of one base name, as other tools
    number theirs (column ``base``); with ``by="none"`` any files, by tasks that read several of them, without a
    shuffle. Partition columns (``key=value`` directories) stay. :func:`place_files` tells which output file a row goes
    to, and rows are sent to the task of that number, one task a file, so a group that holds most rows is many tasks.
    Inputs are never deleted.
    """
    listed = files.select("path", "length", base_name(F.element_at(F.split("path", "/"), -1)).alias("base")).collect()
    paths = [r["path"] for r in listed]  # one row a file
    root = table_root(paths)
    keys = partition_keys(paths, root)
    rows = spark.read.option("mergeSchema", True).option("basePath", root).parquet(*paths)
    columns, split = set(rows.columns), None
    if by == "none":
        merged = rows.coalesce(max(1, math.ceil(sum(r["length"] for r in listed) / target_bytes)))
        folders = keys
    else:
        lengths = {plain_path(r["path"]): (r["base"] if by == "base" else plain_path(r["path"]).rpartition("/")[0], r["length"])
                   for r in listed}
        counted = spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("path")).count().collect()
        held = [(r["path"], *lengths[listed_path(r["path"])], r["count"]) for r in counted]  # one row a file
        placed, slots = place_files(held, target_bytes)
        dealt = _dealt(rows, placed)
        # a split counts a file's bytes and the cost of opening it
        n_rows, n_bytes = sum(h[3] for h in held), sum(h[2] for h in held)
        split = max(1 << 20, min(MERGED_BYTES, n_bytes * MERGED_ROWS // max(1, n_rows)))
        merged = dealt.repartitionById(max(1, slots), "__slot")
        folders = [*keys, "base"] if by == "base" else keys
        if by == "base":
            merged = merged.withColumn("base", F.col("__group"))
        merged = merged.select(*rows.columns, *(["base"] if by == "base" else []))
    seen = Observation()
    writer = merged.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", "zstd")
    splits = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(splits)
    if split is not None:
        spark.conf.set(splits, str(split))
    try:
        (writer.partitionBy(*folders) if folders else writer).parquet(target)
    finally:
        spark.conf.set(splits, before)
    found = spark.read.option("mergeSchema", True).parquet(target)
    if set(found.columns) - {"base"} != columns - {"base"}:
        raise RuntimeError(f"compaction read columns {sorted(columns)}, found {sorted(found.columns)}")
    rows_in, rows_out = rows.count(), found.count()
    if not rows_in == rows_out == seen.get["n"]:
        raise RuntimeError(f"compaction read {rows_in} rows, wrote {seen.get['n']}, found {rows_out}")
    files_out = found.select("_metadata.file_path").distinct().count()
    return {"files_in": len(paths), "files_out": files_out, "rows_in": rows_in, "rows_out": rows_out}
