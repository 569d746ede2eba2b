"""Sinks: zstd Parquet with a row count, report tables, one-row JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.operators.fields import report_line


def write_shredded(df: DataFrame, path: str, lookup: Sequence[str] = ("_id",), partition_by: Sequence[str] = (),
                   max_records_per_file: int | None = None, mode: str = "errorifexists",
                   **metrics) -> dict[str, int]:
    """S13/X05. Write zstd Parquet and return what went through: ``rows`` and any further ``metrics``.

    Columns in ``lookup`` get a Parquet bloom filter, which lets an equality search on random ids skip row
    groups that min/max statistics cannot rule out. Counts are observed on the write itself.
    """
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    writer = observed.write.mode(mode).option("compression", "zstd")
    for column in lookup:
        if column in df.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return {name: int(n or 0) for name, n in seen.get.items()}


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S14. A report table as Parquet."""
    report.write.mode(mode).parquet(path)


def write_text_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S14. The rows of :func:`quire.operators.fields.field_report` as text, one folder per dataset.

    Rows are dealt by ranges of (dataset, section, position), so a report with very many paths is several files, in
    the order of their names; Spark joins small ranges, and a report of ordinary size is one file.
    """
    place = [F.col("dataset"), F.col("section").desc(), F.col("position")]  # selected fields first
    dealt = report.repartitionByRange(*place).sortWithinPartitions(*place)
    dealt.select("dataset", report_line().alias("line")).write.mode(mode).partitionBy("dataset").text(path)


def write_document(document: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S15. A one-row DataFrame with the text column ``value``."""
    document.write.mode(mode).text(path)


_FIELD = "field: string, column: string, pointer: string"


def _section(spark: SparkSession, path: str, name: str, kind: str) -> DataFrame:
    """One part of a stored selection, as column ``part`` of its one row."""
    stored = spark.read.text(path, wholetext=True)
    return stored.select(F.from_json("value", f"struct<{name}: {kind}>")[name].alias("part"))


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """Fields of every dataset from a stored selection: ``dataset, path, column, pointer``."""
    stored = _section(spark, path, "common_fields", f"map<string, array<struct<{_FIELD}>>>")
    own = stored.select(F.explode("part").alias("dataset", "fields")).select("dataset", F.inline("fields"))
    return own.withColumnRenamed("field", "path")


def read_document(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Fields of one dataset from a stored selection: ``path, column, pointer``."""
    return read_selection(spark, path).filter(F.col("dataset") == dataset).drop("dataset")


def read_combined(spark: SparkSession, path: str, group: str) -> DataFrame:
    """Combined fields of a group from a stored selection: ``path, column, pointer, datasets``."""
    stored = _section(spark, path, f"combined_{group}_fields", f"array<struct<{_FIELD}, datasets: array<string>>>")
    return stored.select(F.inline("part")).withColumnRenamed("field", "path")


def read_column_names(spark: SparkSession, path: str) -> DataFrame:
    """The names that a stored selection's run and all before it dealt: ``dataset, path, column``."""
    stored = _section(spark, path, "column_names", "array<struct<dataset: string, field: string, column: string>>")
    return stored.select(F.inline("part")).withColumnRenamed("field", "path")
