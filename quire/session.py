"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings worth having on a cluster. All are ordinary session settings; none is required for right
# results except the time zone when results are compared across engines.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # With this on, a JSON object that repeats a key keeps the last value in the profile instead of
    # being counted as unparsed.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RECOMMENDED` to a session and return it."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a short-lived table.

    On a cluster it lies under ``spark.checkpoint.dir``, which every executor reaches. Only a local
    session without that setting falls back to a temporary folder on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/quire/{name}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.mkdtemp(prefix='quire-')}/{name}"
