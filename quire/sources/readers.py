"""Readers: compressed JSON Lines, schema-inferring JSON, shredded Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.landing import dataset_of, list_files

# Name patterns of the shredded files that are merged, per directory group.
MERGE_PATTERNS = {
    "elasticsearchaux": "{metadata,journals,digital_lending}_*_*.parquet",
    "elasticsearch": "{records,other}_*_*.parquet",
    "aac": "aac_*_*.parquet",
}


def read_lines(spark: SparkSession, paths: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """S01/S02. Lines of plain, gzip or zstd files: ``value, file_path, dataset``.

    Compressed files cannot be split, so each is one task. ``partitions`` spreads the lines over that many
    tasks right after the scan; ask for it when a few large files would otherwise hold up everything after
    them; :func:`spread_for` decides that from the file sizes.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file_path"), dataset_of("_metadata.file_name").alias("dataset")
    )
    return lines if partitions is None else spread(lines, partitions)


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even redistribution by row number: equal lines and long files spread alike, and a retried task sends
    every row where the first attempt sent it."""
    row = F.monotonically_increasing_id()
    return df.withColumn("__row", row).repartition(partitions, "__row").drop("__row")


def spread_for(sizes: Sequence[int], slots: int, target_bytes: int = 128 * 1024 * 1024,
               expansion: float = 6.0) -> int | None:
    """Partitions to spread compressed files of these sizes over, or None when one task per file is balanced.

    Balanced means that the largest file holds at most twice its fair share of the bytes for ``slots`` tasks at
    a time. ``expansion`` is the usual ratio of plain to compressed size.
    """
    total = sum(sizes)
    if total < target_bytes or max(sizes) <= 2 * total / slots:
        return None
    return max(slots, int(total * expansion // target_bytes))


def read_inferred(spark: SparkSession, paths: str | Sequence[str], sampling_ratio: float = 1.0,
                  as_variant: bool = False) -> DataFrame:
    """S09. JSON with inferred types, for files of unknown shape.

    Inference is one extra pass over (a sample of) the files. With ``as_variant`` there is none: each record is
    one VARIANT column ``record``. Keep this output apart from shredded tables; its schema differs.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if as_variant:
        return spark.read.option("singleVariantColumn", "record").json(paths)
    return spark.read.option("samplingRatio", sampling_ratio).json(paths)


def read_shredded(spark: SparkSession, *paths: str, name_glob: str | None = None,
                  merge_schema: bool = False) -> DataFrame:
    """S10-S12. One table from a directory, a glob, a list of files or one file.

    The files of one dataset have one schema. With ``merge_schema`` files written with different field lists combine:
    columns are matched by name and missing ones are NULL; it reads the footer of every file. ``name_glob`` narrows a
    directory to matching file names.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    if name_glob is not None:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(*paths)


def merge_candidates(spark: SparkSession, directory: str, group: str) -> DataFrame:
    """S19. Listing of the Parquet files to merge: those with the group's pattern, else all of them."""
    pattern = MERGE_PATTERNS.get(group, "*.parquet")
    matching = list_files(spark, directory, pattern)
    return matching if not matching.isEmpty() else list_files(spark, directory, "*.parquet")


def file_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """S12. Rows per Parquet file."""
    return (
        spark.read.parquet(*paths)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
