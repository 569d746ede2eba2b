"""Tables clustered by a lookup key, and a zone map that tells which files can hold a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.readers import read_shredded
from quire.sources.sinks import write_shredded

ZONES = "_zones"  # folders with such a name are not part of a table


def write_clustered(df: DataFrame, path: str, key: str, files: int, mode: str = "errorifexists", **options) -> dict[str, int]:
    """S13. Write a table of about ``files`` files in the order of ``key``, with the zone map of the result.

    Rows are dealt by ranges of key and row number: rows of one key that is very frequent fill several files in place of
    one. Options are those of :func:`quire.sources.sinks.write_shredded`.
    """
    row = "__row"
    dealt = df.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(files, key, row)
    counts = write_shredded(dealt.sortWithinPartitions(key).drop(row), path, (key,), mode=mode, **options)
    write_zones(df.sparkSession, path, key, mode)
    return counts


def write_zones(spark: SparkSession, path: str, key: str, mode: str = "errorifexists") -> None:
    """The zone map of a table without partition folders: ``file`` (its name), ``least``, ``greatest``, ``n_rows``,
    ``n_keys`` (not null). Reads the key column alone."""
    rows = spark.read.parquet(path).select(F.col(key).alias("k"), F.col("_metadata.file_name").alias("file"))
    zones = rows.groupBy("file").agg(F.min("k").alias("least"), F.max("k").alias("greatest"),
                                     F.count(F.lit(1)).alias("n_rows"), F.count("k").alias("n_keys"))
    zones.coalesce(1).write.mode(mode).parquet(f"{path}/{ZONES}")


def lookup(spark: SparkSession, path: str, key: str, values: Sequence) -> DataFrame:
    """Rows of a table whose ``key`` is one of ``values``; files whose zone holds none of them are never opened.

    The zone map is a row a file; what comes to the driver are the files that may hold a value, two for each as a rule.
    """
    wanted = sorted({v for v in values if v is not None})
    table = read_shredded(spark, path)
    if not wanted:
        return table.limit(0)
    zones = spark.read.parquet(f"{path}/{ZONES}")
    near = F.exists(F.array(*[F.lit(v) for v in wanted]), lambda v: (F.col("least") <= v) & (F.col("greatest") >= v))
    files = [f"{path.rstrip('/')}/{r['file']}" for r in zones.filter(near).select("file").collect()]
    return read_shredded(spark, *files).filter(F.col(key).isin(wanted)) if files else table.limit(0)
