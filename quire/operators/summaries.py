"""Grouped counts, shares and top-k lists: the shapes nearly every report is made of.

Counts aggregate map-side first, so a key that holds a third of all rows sends one row per task over the
network, not its records.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.values import round2


def compute_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Select computed columns so that filters on them do not compute them again.

    A filter on a plain column slides below its projection, and Spark then evaluates the expression (a JSON
    parse, say) once for the filter and once more for the value. It cannot slide below a generator.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def count_by(df: DataFrame, *keys: str, min_count: int | None = None, count: str = "count") -> DataFrame:
    """Rows per key, keeping only groups with more than ``min_count`` rows when it is given."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return counts if min_count is None else counts.filter(F.col(count) > min_count)


def ranked(counts: DataFrame, by: str, ties: Sequence[str], limit: int | None = None) -> DataFrame:
    """Descending by one column, ties ascending; with ``limit`` Spark keeps only k rows per task."""
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    out = counts.orderBy(*order)
    return out if limit is None else out.limit(limit)


def with_share(counts: DataFrame, count: str = "count", share: str = "percentage") -> DataFrame:
    """Add each row's percentage of the summed count.

    The total is a scalar subquery over the same grouped rows, so Spark reuses the shuffle of the counts
    and no window pulls every group into one task.
    """
    total = counts.agg(F.sum(count).cast("double")).scalar()
    return counts.withColumn(share, round2(F.col(count).cast("double") * 100.0 / total))


def number_summary(value: Column | str, mean: str, low: str, high: str, rounded: bool = False) -> list[Column]:
    """avg (two decimals), min and max of one value."""
    value = F.col(value) if isinstance(value, str) else value
    lo, hi = F.min(value), F.max(value)
    if rounded:
        lo, hi = round2(lo), round2(hi)
    return [round2(F.avg(value)).alias(mean), lo.alias(low), hi.alias(high)]


def quantiles(df: DataFrame, value: str, shares: Sequence[float], exact_rows: int = 1_000_000) -> DataFrame:
    """Exact quantiles (``share``, ``value``): the smallest value that at least that share of rows does not exceed.

    Each pass over the rows counts, for every share, those below and inside the bracket in which its rank must lie, and
    sketches the values inside (KLL); the sketch gives the next, far narrower bracket. A bracket that turns out not to
    hold its rank, which a sketch's error allows now and then, is taken back. Once a bracket has at most ``exact_rows``
    rows or a single value, its values are counted and put in order. Only counts and bounds reach the driver; the number
    of passes grows with the logarithm of the number of rows.
    """
    v = F.col(value)
    rows = df.filter(v.isNotNull())
    number = v.cast("double")
    n = rows.count()
    if not n:
        return rows.select(F.lit(0.0).alias("share"), value).limit(0)
    ranks = [max(1, math.ceil(s * n)) for s in shares]  # within the bracket, once it has been counted
    whole = (None, None)
    brackets: list[tuple[float | None, float | None]] = [whole] * len(shares)
    done = n <= exact_rows
    wider, slack = list(brackets), [_SLACK] * len(shares)
    while not done:
        passes = []
        for i, (lo, hi) in enumerate(brackets):
            inside = _within(number, lo, hi)
            passes += [F.count_if(number < F.lit(lo) if lo is not None else F.lit(False)).alias(f"below{i}"),
                       F.count_if(inside).alias(f"inside{i}"),
                       F.kll_sketch_agg_double(F.when(inside, number), F.lit(_SKETCH)).alias(f"sketch{i}")]
        found = rows.agg(*passes).first()
        done = True
        for i, s in enumerate(shares):
            (lo, hi), size = brackets[i], found[f"inside{i}"]
            ranks[i] = max(1, math.ceil(s * n)) - found[f"below{i}"]
            if not 1 <= ranks[i] <= size:  # not in there after all
                brackets[i], wider[i], slack[i], done = wider[i], whole, 4 * slack[i], False
            elif size > exact_rows and (lo is None or lo != hi):
                places = [min(1.0, max(0.0, ranks[i] / size + off)) for off in (-slack[i], slack[i])]
                sketch = F.lit(bytes(found[f"sketch{i}"]))  # about 20 kB
                low, high = df.sparkSession.range(1).select(
                    *[F.kll_sketch_get_quantile_double(sketch, F.lit(p)).alias(str(k)) for k, p in enumerate(places)]).first()
                new = (low if lo is None else max(lo, low), high if hi is None else min(hi, high))
                if new != (lo, hi):
                    wider[i], brackets[i], done = (lo, hi), new, False
    held = [_within(number, lo, hi) for lo, hi in brackets]
    counts = rows.filter(reduce(Column.__or__, held)).groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    which = F.filter(F.array(*[F.when(h, F.lit(i)) for i, h in enumerate(held)]), lambda i: i.isNotNull())
    run = F.sum("__n").over(Window.partitionBy("__i").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ordered = counts.select("*", F.explode(which).alias("__i")).withColumn("__run", run)
    met = ordered.filter(F.col("__run") >= F.array(*[F.lit(r) for r in ranks])[F.col("__i")])
    share = F.array(*[F.lit(float(s)) for s in shares])[F.col("__i")]
    return met.groupBy("__i").agg(F.min(value).alias(value)).select(share.alias("share"), value)


_SKETCH = 2048  # size of a sketch: ranks are off by 0.25 % of its rows, seldom more
_SLACK = 0.01


def _within(number: Column, lo: float | None, hi: float | None) -> Column:
    above = F.lit(True) if lo is None else number >= F.lit(lo)
    return above if hi is None else above & (number <= F.lit(hi))
