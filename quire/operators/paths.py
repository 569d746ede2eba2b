"""Which key paths do the records of a dump hold, and how many records hold each?

A record is parsed once and opened level by level with ``variant_explode``: every object key is reported,
whatever its value; of an array only the first element is opened, and only if it is an object or array.
All levels are one narrow chain above a single scan, so the whole profile costs one shuffle, of one
pre-aggregated row per path and task. Levels beyond the unrolled ones are rare; records that have them are
finished inside their row, so no nesting depth is ever cut off.

Paths travel as pointers: ``/`` before each step, ``~1`` and ``~0`` for ``/`` and ``~`` inside a key, and
``~i`` for "first element". Unlike dotted text, a pointer cannot confuse the key ``a.b`` with ``a`` -> ``b``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INDEX_STEP = "~i"
UNROLLED_LEVELS = 8


def sample_rows(df: DataFrame, rate: float, seed: int = 0, on: Column | None = None,
                keys: tuple[str, ...] = ("value", "file_path")) -> DataFrame:
    """Keep about ``rate`` of the rows, chosen by a hash of ``keys`` and the seed, or by the integer ``on``.

    The choice depends on the row alone: another cluster, partitioning or rerun keeps the same rows. Copies of one
    line in one file are kept or left together.
    """
    if rate >= 1.0:
        return df
    if on is None:
        on = F.xxhash64(*[F.col(k) for k in keys if k in df.columns], F.lit(seed))
    return df.filter(F.pmod(on, F.lit(1_000_000)) < F.lit(round(rate * 1_000_000)))


def sample_files(files: DataFrame, rate: float, seed: int = 0, on: Column | None = None) -> DataFrame:
    """Keep ``floor(n * rate)`` files of each dataset, but at least one.

    ``files`` holds one row per file (``path``, ``dataset``), not the records. The order within a dataset is
    a hash of the path (or ``on``), so a rerun picks the same files.
    """
    order = F.xxhash64("path", F.lit(seed)) if on is None else on
    by_hash = Window.partitionBy("dataset").orderBy(order, "path")
    size = F.count(F.lit(1)).over(Window.partitionBy("dataset"))
    kept = files.withColumn("__n", F.row_number().over(by_hash)).withColumn("__size", size)
    return kept.filter(
        F.col("__n") <= F.greatest(F.lit(1), F.floor(F.col("__size") * F.lit(rate)))
    ).drop("__n", "__size")


def sample_files_by_size(files: DataFrame, rate: float, seed: int = 0, on: Column | None = None,
                         start: float | None = None) -> DataFrame:
    """Files drawn with a chance in proportion to their bytes, and the ``weight`` that each stands for.

    About ``rate`` of a dataset's files, at least one: they are laid out by a hash of the path, each as long as its chance
    (its bytes over the mean of one draw, one at most), and those that hold the points ``start``, ``start + 1`` and so on
    are taken; ``start`` hangs on the seed. A file's weight is one over its chance, so sums of weights estimate the whole
    dataset without bias, whether its files are of one size or a few hold nearly all (Horvitz and Thompson).
    """
    order = F.xxhash64("path", F.lit(seed)) if on is None else on
    own = Window.partitionBy("dataset")
    size = F.greatest(F.col("length"), F.lit(1)).cast("double")
    draws = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(own) * F.lit(rate)))
    first = F.pmod(F.xxhash64("dataset", F.lit(seed)), F.lit(1_000_000)) / 1_000_000 if start is None else F.lit(start)
    laid = files.withColumn("__chance", F.least(F.lit(1.0), draws * size / F.sum(size).over(own)))
    ends = F.sum("__chance").over(own.orderBy(order, "path").rowsBetween(Window.unboundedPreceding, 0))
    laid = laid.withColumn("__end", ends - first)
    taken = F.floor("__end") > F.floor(F.col("__end") - F.col("__chance"))
    return laid.filter(taken).withColumn("weight", 1 / F.col("__chance")).drop("__chance", "__end")


_STEP = "concat(pointer, '/', replace(replace({key}, '~', '~0'), '/', '~1'))"
_FIRST = f"concat(pointer, '/{INDEX_STEP}')"

# Paths below a node that is still open after the unrolled levels, one step for each level that it really has.
_DEEPER = """
aggregate(
  sequence(1, greatest(1, aggregate(
    split(regexp_replace(regexp_replace(regexp_replace(
      cast(node as string), '\\\\\\\\.', ''), '"[^"]*"', ''), '[^{}\\\\[\\\\]]', ''), ''),
    named_struct('now', 0, 'most', 0),
    (d, c) -> if(c in ('{', '['), named_struct('now', d.now + 1, 'most', greatest(d.most, d.now + 1)),
                 if(c in ('}', ']'), named_struct('now', d.now - 1, 'most', d.most), d)),
    d -> d.most))),
  named_struct('open', array(named_struct('pointer', pointer, 'key', false, 'node', node)),
               'found', cast(array() as array<string>)),
  (acc, i) -> named_struct(
    'open', flatten(transform(acc.open, o -> concat(
      coalesce(transform(map_entries(try_variant_get(o.node, '$', 'map<string,variant>')), e -> named_struct(
        'pointer', concat(o.pointer, '/', replace(replace(e.key, '~', '~0'), '/', '~1')),
        'key', true, 'node', e.value)), array()),
      filter(array(named_struct('pointer', concat(o.pointer, '/~i'), 'key', false,
        'node', try_variant_get(o.node, '$[0]', 'variant'))), f -> f.node is not null)))),
    'found', concat(acc.found, transform(filter(acc.open, o -> o.key), o -> o.pointer))),
  acc -> concat(acc.found, transform(filter(acc.open, o -> o.key), o -> o.pointer)))
"""


def key_pointers(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ("dataset",),
                 levels: int = UNROLLED_LEVELS) -> DataFrame:
    """One row per record and key path: ``keep`` columns and ``pointer``.

    Each parsed record also gives one row with the empty pointer, and each line that is no single JSON
    value one row with a NULL pointer, so record totals come out of the same pass. Blank lines give none.
    """
    # The brackets make trailing text after the value a parse error instead of something to ignore.
    parsed = lines.select(*keep, F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit("]"))).alias("doc"))
    tvf = lines.sparkSession.tvf
    lone = "try_variant_get(doc, '$[1]', 'variant') is null"
    opened = parsed.lateralJoin(tvf.variant_explode_outer(F.col("doc").outer())).select(
        *keep,
        F.expr(
            f"""inline(case
              when doc is null or (pos = 0 and not ({lone})) then
                array(named_struct('pointer', cast(null as string), 'node', cast(null as variant)))
              when pos = 0 then array(named_struct('pointer', '', 'node', cast(null as variant)),
                                      named_struct('pointer', '', 'node', value)) end)"""
        ),
    )
    for _ in range(levels):
        opened = opened.lateralJoin(tvf.variant_explode_outer(F.col("node").outer())).select(
            *keep,
            F.expr(
                f"""inline(case
                  when node is null then array(named_struct('pointer', pointer, 'node', node))
                  when key is not null then
                    array(named_struct('pointer', {_STEP.format(key='key')}, 'node', cast(null as variant)),
                          named_struct('pointer', {_STEP.format(key='key')}, 'node', value))
                  when pos = 0 then array(named_struct('pointer', {_FIRST}, 'node', value)) end)"""
            ),
        )
    rest = F.expr(f"case when node is null then array(pointer) else {_DEEPER} end")
    return opened.select(*keep, F.explode(rest).alias("pointer"))


def pointer_steps(pointer: str = "pointer") -> Column:
    """Pointer to its steps, keys unescaped; an index step stays ``~i``, which no unescaped key step equals
    unless it is an index (keys carry ``~`` as ``~0``)."""
    return F.expr(f"split(substr({pointer}, 2), '/')")


def pointer_text(pointer: str = "pointer") -> Column:
    """Dotted path text: keys joined by ``.``, first elements as ``[0]``."""
    return F.expr(
        f"""aggregate(split(substr({pointer}, 2), '/'), '', (path, step) ->
          if(step = '{INDEX_STEP}', concat(path, '[0]'),
             concat(if(path = '', '', concat(path, '.')), replace(replace(step, '~1', '/'), '~0', '~'))))"""
    )


def count_paths(lines: DataFrame, value: str = "value", levels: int = UNROLLED_LEVELS,
                weight: str | None = None) -> DataFrame:
    """Records per (dataset, pointer), including the total and unparsed rows described above; ``weight`` names a column
    of which the sum is wanted too (``w``)."""
    found = key_pointers(lines, value, ("dataset", *([weight] if weight else [])), levels)
    sums = [F.sum(weight).alias("w")] if weight else []
    return found.groupBy("dataset", "pointer").agg(F.count(F.lit(1)).alias("n"), *sums)


def _rate(rate: float | Mapping[str, float]) -> Column:
    """Sampling rate as a column; a mapping gives one rate per dataset."""
    if not isinstance(rate, Mapping):
        return F.lit(float(rate))
    return F.create_map(*[F.lit(x) for d, r in rate.items() for x in (d, float(r))])[F.col("dataset")]


def scale_up(count: Column | str, rate: float | Mapping[str, float]) -> Column:
    """Sample count to an estimate for the whole population: divide by the sampling rate."""
    count = F.col(count) if isinstance(count, str) else count
    return F.round(count / _rate(rate), 0).cast("bigint")


def profile(lines: DataFrame, rate: float | Mapping[str, float] = 1.0, value: str = "value",
            levels: int = UNROLLED_LEVELS, weight: str | None = None) -> DataFrame:
    """Field profile of (already sampled) lines.

    ``dataset, path, pointer, n_records, total_records`` as estimates for the whole, ``sampled_n`` and
    ``sampled_total`` as counted, and ``n_unparsed``: sampled lines that are no JSON value. Estimates are counts over the
    ``rate``; where lines were drawn with different chances, the column ``weight`` tells how many each stands for, and
    ``share`` is the weighted share of records that hold the path.
    """
    counts = count_paths(lines, value, levels, weight)
    # Two numbers a dataset, joined to the paths: records with ids for keys have as many paths as records, so paths of a
    # dataset never meet in one task. Both sides read the one shuffle of the counts, hence no filter before the sums.
    root = F.col("pointer") == ""
    whole = counts.groupBy(F.col("dataset").alias("__dataset")).agg(
        F.coalesce(F.sum(F.when(root, F.col("n"))), F.lit(0)).alias("sampled_total"),
        F.coalesce(F.sum(F.when(F.col("pointer").isNull(), F.col("n"))), F.lit(0)).alias("n_unparsed"),
        *([F.sum(F.when(root, F.col("w"))).alias("__whole")] if weight else []),
    )
    totals = counts.join(whole, F.col("dataset").eqNullSafe(F.col("__dataset"))).filter(F.col("pointer") != "")
    estimate = (lambda c: F.round(c, 0).cast("bigint")) if weight else (lambda c: scale_up(c, rate))
    return totals.select(
        "dataset",
        pointer_text().alias("path"),
        "pointer",
        estimate("w" if weight else "n").alias("n_records"),
        estimate("__whole" if weight else "sampled_total").alias("total_records"),
        F.col("n").alias("sampled_n"),
        "sampled_total",
        "n_unparsed",
        *([(F.col("w") / F.col("__whole")).alias("share")] if weight else []),
    )


def record_totals(counts: DataFrame) -> DataFrame:
    """Parsed records and unparsed lines per dataset, from :func:`count_paths`."""
    return (
        counts.filter(F.col("pointer").isNull() | (F.col("pointer") == ""))
        .groupBy("dataset")
        .agg(
            F.coalesce(F.sum(F.when(F.col("pointer") == "", F.col("n"))), F.lit(0)).alias("n_records"),
            F.coalesce(F.sum(F.when(F.col("pointer").isNull(), F.col("n"))), F.lit(0)).alias("n_unparsed"),
        )
    )
