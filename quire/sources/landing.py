"""Which files of a landing area are taken in, and which dataset each belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File-name patterns (anchored at the start), directory groups in the order they are tried,
# and the smallest file worth taking.
AAC_FILE = r"^[a-z_]+_meta__aacid__(.+?)__.*\.jsonl(?:\.seekable)?\.zst"
DATASET_FILES = {
    "records": r"^aarecords__?\d+\.json\.gz",
    "metadata": r"^aarecords_metadata.*json\.gz",
    "journals": r"^aarecords_journals.*json\.gz",
    "digital_lending": r"^aarecords_digital_lending.*json\.gz",
}
OTHER = "other"
GROUPS = ("elasticsearchaux", "elasticsearch", "aac")
MIN_FILE_BYTES = 2 * 1024 * 1024


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dataset_of(file_name: Column | str) -> Column:
    """S04. Dataset by file name; container collections first, ``other`` when nothing fits."""
    name = _col(file_name)
    found = F.when(name.rlike(AAC_FILE), F.concat(F.lit("aac_"), F.regexp_extract(name, AAC_FILE, 1)))
    for dataset, pattern in DATASET_FILES.items():
        found = found.when(name.rlike(pattern), F.lit(dataset))
    return found.otherwise(F.lit(OTHER))


def group_of(directory: Column | str) -> Column:
    """S05. Dataset group by directory name; an unknown directory is its own group."""
    name = _col(directory)
    found = F.when(name.contains(GROUPS[0]), F.lit(GROUPS[0]))
    for group in GROUPS[1:]:
        found = found.when(name.contains(group), F.lit(group))
    return found.otherwise(name)


def base_name(file_name: Column | str) -> Column:
    """S17. Merge group of a Parquet file: its name without a trailing ``_<n>`` and the extension."""
    return F.regexp_replace(F.regexp_replace(_col(file_name), r"\.[^.]*$", ""), r"_[0-9]+$", "")


def list_files(spark: SparkSession, root: str, name_glob: str = "*") -> DataFrame:
    """Every file below ``root``: ``path, file_name, directory, length``. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .load(root)
        .select("path", "length")
    )
    parts = F.split("path", "/")
    return files.select(
        "path", F.element_at(parts, -1).alias("file_name"), F.element_at(parts, -2).alias("directory"), "length"
    )


def landing_files(spark: SparkSession, root: str, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """S03. Files under ``aa*/<group>/`` with the extension of their group and at least ``min_bytes``.

    Returns the listing with ``dataset_group`` and ``dataset``; nothing is moved.
    """
    files = list_files(spark, root)
    group = F.col("directory")
    parent = F.element_at(F.split("path", "/"), -3)
    extension = F.when(group == "aac", F.col("file_name").endswith(".zst")).otherwise(
        F.col("file_name").endswith(".gz")
    )
    return (
        files.filter(parent.startswith("aa") & group.isin(*GROUPS) & extension)
        .filter(F.col("length") >= min_bytes)
        .select("path", "file_name", "length", group_of(group).alias("dataset_group"),
                dataset_of("file_name").alias("dataset"))
    )
