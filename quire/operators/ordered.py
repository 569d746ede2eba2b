"""Running totals and numbers within groups, whatever the size of a group.

A window over a group is one task for each group. Here the rows are cut into blocks of bounded size by the order itself
(range partitions of group and order, written once), each block runs its own total, and the totals of a group's earlier
blocks are added. A group then is as many tasks as it has blocks; only the block sums, one row for each million rows,
meet in a window of the group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import scratch_path

BLOCK_ROWS = 1_000_000


def running_totals(rows: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column | int = 1,
                   name: str = "total", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the group's rows up to and including each.

    Every column of ``rows`` travels through two shuffles: hand in narrow rows. The order within a group should have no
    ties; rows that tie get their totals in any order. Rows are written to the scratch folder twice: as they come, whose
    footers tell how many blocks to make, and cut into blocks, which therefore stay the same when a task is repeated.
    """
    spark = rows.sparkSession
    unordered = scratch_path(spark, "rows")
    rows.withColumn("__value", F.lit(value) if isinstance(value, int) else value).write.parquet(unordered)
    stored = spark.read.parquet(unordered)
    blocks = max(1, math.ceil(stored.count() / block_rows))
    cut = scratch_path(spark, "blocks")
    by = [*[F.col(g).asc_nulls_first() for g in group], *order]
    dealt = stored.repartitionByRange(blocks, *by).withColumn("__block", F.spark_partition_id())
    dealt.write.parquet(cut)
    blocked = spark.read.parquet(cut)
    sums = blocked.groupBy(*group, "__block").agg(F.sum("__value").alias("__sum"))  # a row a block, and one a group
    earlier = Window.partitionBy(*group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__block").alias("__b"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*group, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = blocked.withColumn("__run", F.sum("__value").over(within))
    same = F.col("__block") == F.col("__b")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return run.join(before, same).select(*rows.columns, (F.col("__before") + F.col("__run")).alias(name))


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "position",
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with their place in the group, from 1."""
    return running_totals(rows, group, order, 1, name, block_rows).withColumn(name, F.col(name).cast("int"))
