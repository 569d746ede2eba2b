"""Folders of a file system that Spark reaches: is one there, move a finished one to its place, remove an own one."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder?"""
    system, where = _at(spark, path)
    return system.exists(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Publish a finished file or folder: rename it to a path where nothing is yet."""
    system, there = _at(spark, target)
    if system.exists(there):
        raise FileExistsError(f"{target} already exists")
    system.mkdirs(there.getParent())
    if not system.rename(_at(spark, source)[1], there):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library staged."""
    system, where = _at(spark, path)
    system.delete(where, True)


def plain_path(path: str) -> str:
    """A path with one slash after its scheme, as listings and file metadata write it differently."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", path)


def listed_path(metadata_path: str) -> str:
    """The path of a listing that ``_metadata.file_path`` writes as a URI."""
    return plain_path(unquote(metadata_path))


def plain_file(metadata_path: str) -> Column:
    """:func:`listed_path` of a column."""
    scheme = F.regexp_replace(metadata_path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")
    return F.url_decode(F.replace(scheme, F.lit("+"), F.lit("%2B")))
