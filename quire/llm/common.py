"""What the operators of this subpackage share: reading tables, scratch tables, Arrow helpers."""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_path

# The white space that parts words, everywhere in this subpackage: space and U+0009 to U+000D.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: its lineage ends there.

    A lost executor then costs a task, not the steps before it, and nothing is computed twice. Spark removes the
    shuffle files of finished steps once the driver has collected their handles; asking for that here keeps the
    disk to about what one step needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow text column; a null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; a null is the empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slots(df: DataFrame, count: int, name: str = "slot") -> DataFrame:
    """Deal the rows of a stored table evenly over ``count`` slots, whatever their keys.

    The number comes from a row's place in its file, so a repeated run deals alike.
    """
    return df.withColumn(name, F.pmod(F.monotonically_increasing_id(), F.lit(count)).cast("int"))
