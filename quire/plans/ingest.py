"""The whole way from compressed dumps to queryable Parquet.

One call per directory group. The data-dependent steps are two: the profile is written as a table (it is a
report anyway, and reading it back cuts the lineage of everything after it), and the selected field list is
collected, because it becomes the projection. Everything else is one plan from scan to write per dataset: good and bad
lines are parsed once, staged side by side and moved to their places when the write is done, so a bad line costs no
second look at the dump, and a table is there whole or not at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.functions.columns import AAC_KEYS, ENVELOPE_KEYS, METADATA, SOURCE
from quire.operators import fields as fl
from quire.operators import shred as sh
from quire.operators.inferred import RECORD, parsed_records, record_type, typed
from quire.operators.layout import TARGET_FILE_BYTES, line_bytes
from quire.operators.paths import count_paths, profile, record_totals, sample_files_by_size, sample_rows
from quire.sources.files import exists, listed_path, move, plain_file, plain_path, remove
from quire.sources.landing import landing_files
from quire.sources.readers import read_lines, spread, spread_for
from quire.sources.sinks import (
    read_column_names, read_selection, write_document, write_report, write_shredded, write_text_report,
)

# Fixed value: share of the input that is profiled.
SAMPLE_RATE = 0.20


@dataclass
class IngestOptions:
    """Everything a run can vary. ``sample_unit`` is ``"row"`` or ``"file"``; ``quarantine`` is ``"row"`` or ``"file"``.
    Output files are merged to about ``target_file_bytes`` of compressed input each, or to ``merged_line_bytes`` of lines
    where that is less, since one task takes in what becomes one file; ``target_file_bytes`` of 0 leaves one for each task."""

    min_file_bytes: int = 2 * 1024 * 1024
    sample_rate: float = SAMPLE_RATE
    sample_unit: str = "row"
    seed: int = 0
    threshold: float = fl.PRESENCE_THRESHOLD
    aac_threshold: float = fl.AAC_PRESENCE_THRESHOLD
    quarantine: str = "row"
    keep_corrupt: bool = False
    partition_target_bytes: int = 128 * 1024 * 1024
    target_file_bytes: int = TARGET_FILE_BYTES
    merged_line_bytes: int = 256 * 1024 * 1024
    max_records_per_file: int | None = None
    concurrent_jobs: int = 4
    ledger: bool = True  # count what good records lose (shred.DEFECT_BITS)


@dataclass
class IngestResult:
    """Where things are and how many rows went where, per dataset. ``defects`` counts good records by what they lost;
    ``inferred`` are the datasets whose records no selected field fits, written with the types they have."""

    tables: dict[str, str] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    defects: dict[str, dict[str, int]] = field(default_factory=dict)
    inferred: dict[str, str] = field(default_factory=dict)
    profile_path: str | None = None
    selection_path: str | None = None


def is_aac(dataset: str) -> bool:
    return dataset.startswith(fl.AAC_PREFIX)


def fields_for(selected: DataFrame, group: str, known: DataFrame | None = None) -> dict[str, list[sh.Field]]:
    """X03. Field list of every dataset. It has to reach the driver, since it becomes the projection; a path
    is in it only if at least the threshold share of records holds it, so the list is as wide as the table."""
    chosen: dict[str, list[sh.Field]] = {}
    for r in fl.fields_per_dataset(selected, group, known).orderBy("dataset", "path").collect():
        chosen.setdefault(r["dataset"], []).append(sh.Field(r["path"], r["column"], r["pointer"]))
    return chosen


def _files_by_dataset(files: DataFrame) -> dict[str, dict[str, int]]:
    """dataset -> path -> bytes; one entry per input file."""
    found: dict[str, dict[str, int]] = {}
    for r in files.select("path", "length", "dataset").collect():
        found.setdefault(r["dataset"], {})[r["path"]] = r["length"]
    return dict(sorted(found.items()))


def _lines(spark: SparkSession, files: dict[str, int], o: IngestOptions, rate: float = 1.0) -> DataFrame:
    """Lines of one dataset, sampled, then spread if a few large files hold most of it."""
    lines = sample_rows(read_lines(spark, list(files)), rate, o.seed)
    n = spread_for(list(files.values()), spark.sparkContext.defaultParallelism, o.partition_target_bytes)
    return lines if n is None else spread(lines, n)


def _sampled(spark: SparkSession, files: DataFrame, datasets: dict[str, dict[str, int]], o: IngestOptions) -> DataFrame:
    """The profile of a sample of every dataset.

    Sampling files leaves the others unread, and each line stands for the weight of its file; sampling rows has to
    decompress everything, and each stands for one over the rate.
    """
    if o.sample_unit not in ("row", "file"):
        raise ValueError(f"sample_unit is row or file, not {o.sample_unit}")
    if o.sample_unit == "row":
        parts = [_lines(spark, own, o, o.sample_rate).withColumn("dataset", F.lit(d)) for d, own in datasets.items()]
        return profile(reduce(DataFrame.unionByName, parts), {d: o.sample_rate for d in datasets})
    drawn = sample_files_by_size(files, o.sample_rate, o.seed).select("dataset", "path", "length", "weight").collect()
    weights = spark.createDataFrame([(plain_path(r["path"]), r["weight"]) for r in drawn], "__file string, weight double")
    chosen: dict[str, dict[str, int]] = {}
    for r in drawn:  # a row a file
        chosen.setdefault(r["dataset"], {})[r["path"]] = r["length"]
    parts = [_lines(spark, own, o).withColumn("dataset", F.lit(d)) for d, own in chosen.items()]
    lines = reduce(DataFrame.unionByName, parts)
    return profile(lines.join(weights, plain_file("file_path") == F.col("__file")), weight="weight")


def _profiled(spark: SparkSession, files: DataFrame, datasets: dict[str, dict[str, int]], o: IngestOptions,
              path: str) -> DataFrame:
    """The profile of all datasets, written to ``path`` and read back."""
    write_report(_sampled(spark, files, datasets, o), path)
    stored = spark.read.parquet(path)
    # a sample may hold no good record of a small dataset: such a dataset is profiled whole
    seen = {r["dataset"] for r in stored.select("dataset").distinct().collect()}  # at most one a dataset
    if missing := [d for d in datasets if d not in seen]:
        whole = reduce(DataFrame.unionByName, [_lines(spark, datasets[d], o).withColumn("dataset", F.lit(d)) for d in missing])
        weighed = {"weight": "weight"} if o.sample_unit == "file" else {}
        write_report(profile(whole.withColumn("weight", F.lit(1.0)), **weighed), path, mode="append")
        stored = spark.read.parquet(path)
    return stored


def ingest_group(spark: SparkSession, files: DataFrame, target: str, group: str,
                 options: IngestOptions | None = None, selection: str | None = None,
                 names: str | None = None) -> IngestResult:
    """X04. Profile, select, report, shred and write every dataset of one directory group.

    ``files`` is a listing with ``path, length, dataset``. Output under ``target``: ``_reports/`` (profile,
    selected and combined fields, the text report, the selection document, defects), ``<dataset>/``,
    ``_quarantine/<dataset>/`` (``file_path, line``: the text as it was read) and ``_inferred/<dataset>/``.

    ``selection`` is the selection document of an earlier run (``selection_path`` of its result): its fields and names
    are taken as they are and nothing is profiled; datasets that it does not know go the inferred way. ``names`` is such
    a document too, of which only the names hold: the records are profiled anew, a path that had a column keeps its name,
    and names of new paths are numbered on.
    """
    o = options or IngestOptions()
    reports = f"{target}/_reports"
    result = IngestResult()
    datasets = _files_by_dataset(files)
    if not datasets:
        return result
    if not 0 < min(o.threshold, o.aac_threshold):
        raise ValueError("thresholds must be above zero: they bound the number of columns")
    for dataset in datasets:
        if exists(spark, f"{target}/{dataset}"):
            raise FileExistsError(f"{target}/{dataset} already exists")

    if selection is not None:
        result.selection_path = selection
        known = read_column_names(spark, selection)
        chosen = fields_for(read_selection(spark, selection), group, known)
    else:
        result.profile_path, result.selection_path = f"{reports}/profile", f"{reports}/selection"
        known = None if names is None else read_column_names(spark, names)
        stored = _profiled(spark, files, datasets, o, result.profile_path)
        write_report(fl.select_fields(stored, o.threshold, o.aac_threshold, known), f"{reports}/selected")
        selected = spark.read.parquet(f"{reports}/selected")
        chosen = fields_for(selected, group, known)

    def report() -> None:
        method = f"{o.sample_unit} sample of {o.sample_rate:.0%} per dataset, counts scaled up"
        write_text_report(fl.field_report(stored, selected), f"{reports}/text")
        write_report(fl.combined_report(fl.combined_fields(selected, group, known)), f"{reports}/combined")
        write_report(fl.shared_fields(selected, stored, group), f"{reports}/shared")
        aac = F.col("dataset").startswith(fl.AAC_PREFIX)
        dropped = [fl.dropped_keys(stored.filter(~aac), [SOURCE], [*ENVELOPE_KEYS, SOURCE]),
                   fl.dropped_keys(stored.filter(aac), [METADATA], [*AAC_KEYS])]
        write_report(dropped[0].unionByName(dropped[1]), f"{reports}/dropped")
        document = fl.selection_document(stored, selected, group, method, o.threshold, o.aac_threshold, known)
        write_document(document, result.selection_path)

    def write(dataset: str) -> None:
        own = chosen.get(dataset, [])
        lines = _lines(spark, datasets[dataset], o).drop("dataset")
        job = _Write(spark, lines, is_aac(dataset), own, dataset, target, datasets[dataset], o)
        if sh.nested_under(own, METADATA if is_aac(dataset) else SOURCE):
            counts, result.defects[dataset] = job.shredded()
            result.tables[dataset] = f"{target}/{dataset}"
        else:
            counts = job.inferred()
            result.inferred[dataset] = f"{target}/_inferred/{dataset}"
        result.counts[dataset] = {**counts, "fields": len(own)}

    # A few writers side by side in a task need no sort by the flag that parts good rows from bad ones.
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, "4")
    try:
        # Independent jobs, submitted side by side so that the tail of one does not leave the cluster idle.
        with ThreadPoolExecutor(max_workers=o.concurrent_jobs) as pool:
            jobs = [pool.submit(write, d) for d in datasets]
            for done in [*([pool.submit(report)] if selection is None else []), *jobs]:
                done.result()
    finally:
        spark.conf.set(writers, before)
    if result.defects and o.ledger:
        rows = [(d, name, n) for d, found in sorted(result.defects.items()) for name, n in found.items()]
        write_report(spark.createDataFrame(rows, "dataset string, defect string, n_records long").coalesce(1), f"{reports}/defects")
    return result


def _merged_files(sizes: list[int], o: IngestOptions, plain: Callable[[], int]) -> int | None:
    """How many files to merge a dataset's output into; None where one for each input file is no more than that.

    ``plain`` counts the bytes of the lines. That takes one more look at the files, so only a dataset to be merged is."""
    if not o.target_file_bytes:
        return None
    wanted = max(1, math.ceil(sum(sizes) / o.target_file_bytes))
    if wanted < len(sizes):
        wanted = max(wanted, math.ceil(plain() / o.merged_line_bytes))
    return wanted if wanted < len(sizes) else None


@dataclass
class _Write:
    """The way of one dataset's lines to their tables. Rows are staged first and published when all are written."""

    spark: SparkSession
    lines: DataFrame
    aac: bool
    chosen: list[sh.Field]
    dataset: str
    target: str
    files: dict[str, int]
    o: IngestOptions

    @property
    def path(self) -> str:
        return f"{self.target}/{self.dataset}"

    @property
    def quarantine(self) -> str:
        return f"{self.target}/_quarantine/{self.dataset}"

    @property
    def lookup(self) -> tuple[str, ...]:
        return ("aacid",) if self.aac else ("_id",)

    def _gathered(self, df: DataFrame) -> DataFrame:
        """Rows over as many partitions as there shall be files."""
        merged = _merged_files(list(self.files.values()), self.o, self._line_bytes)
        return df if merged is None else spread(df, merged)

    def _line_bytes(self) -> int:
        return read_lines(self.spark, list(self.files)).agg(F.sum(line_bytes())).first()[0] or 0

    def _put(self, df: DataFrame, path: str, **more) -> dict[str, int]:
        return write_shredded(df, path, self.lookup, max_records_per_file=self.o.max_records_per_file, **more)

    def shredded(self) -> tuple[dict[str, int], dict[str, int]]:
        """Rows and quarantined lines, and good records by defect. The lines are parsed once, whatever is in them."""
        o, shred = self.o, sh.shred_aac if self.aac else sh.shred_search
        if self.aac:
            parsed = sh.parse_aac_lines(self.lines, ledger=o.ledger)
        else:
            parsed = sh.parse_search_lines(self.lines, fields=self.chosen, ledger=o.ledger)
        seen = Observation()
        found = {name: F.count_if(sh.has_defect(name)) for name in sh.DEFECT_BITS} if o.ledger else {}
        parsed = parsed.observe(seen, F.count_if(F.col(sh.CORRUPT).isNotNull()).alias("bad"),
                                *[c.alias(n) for n, c in found.items()])
        if o.keep_corrupt:
            counts = {**self._put(self._gathered(shred(parsed, self.chosen, keep_corrupt=True)), self.path), "quarantined": 0}
        else:
            counts = self._split(shred(parsed, self.chosen, ("file_path", sh.CORRUPT), keep_corrupt=True), seen)
        return counts, {name: seen.get[name] for name in found}

    def _split(self, rows: DataFrame, seen: Observation) -> dict[str, int]:
        """Good rows to the table, bad ones to the quarantine, by way of a staged table parted by a flag.

        A bad line's text and file stand in two columns of the table's own (text) columns, so that the good rows' files
        are finished as they are staged.
        """
        stage = f"{self.target}/_staged/{self.dataset}"
        where, text = AAC_KEYS if self.aac else ENVELOPE_KEYS[:2]
        bad = F.col(sh.CORRUPT).isNotNull()
        columns = [c for c in rows.columns if c not in ("file_path", sh.CORRUPT)]
        held = {where: F.when(bad, F.col("file_path")).otherwise(F.col(where)),
                text: F.when(bad, F.col(sh.CORRUPT)).otherwise(F.col(text))}
        by_file = self.o.quarantine != "row"
        staged = rows.select(*[held.get(c, F.col(c)).alias(c) for c in columns], bad.alias("__bad"),
                             *([F.col("file_path").alias("__file")] if by_file else []))
        # files can be told apart only when all is read, so rows of bad files are left out on the way from the stage
        written = self._put(staged if by_file else self._gathered(staged), stage, partition_by=["__bad"], mode="overwrite")
        n_bad = seen.get["bad"]
        good, set_aside = f"{stage}/__bad=false", f"{stage}/__bad=true"
        if not exists(self.spark, good):
            self._put(self.spark.createDataFrame([], staged.drop("__bad").schema), good)
        counts = {"rows": written["rows"] - n_bad, "quarantined": n_bad}
        if by_file:
            kept = self.spark.read.parquet(good)
            if n_bad:
                bad_files = self.spark.read.parquet(set_aside).select("__file").distinct()
                kept = kept.join(bad_files, "__file", "left_anti")
                whole = {listed_path(r["__file"]) for r in bad_files.collect()}  # at most one an input file
                texts = read_lines(self.spark, [p for p in self.files if plain_path(p) in whole]).filter(sh.not_blank())
                lines = texts.select("file_path", F.col("value").alias("line"))
                counts["quarantined"] = write_shredded(lines, self.quarantine, lookup=())["rows"]
            counts["rows"] = self._put(self._gathered(kept.drop("__file")), self.path)["rows"]
        else:
            if n_bad:
                lines = self.spark.read.parquet(set_aside).select(F.col(where).alias("file_path"), F.col(text).alias("line"))
                write_shredded(lines, self.quarantine, lookup=())
            move(self.spark, good, self.path)
        remove(self.spark, stage)
        return counts

    def inferred(self) -> dict[str, int]:
        """S09. Records without any selected field, with the types they have, beside the shredded tables."""
        records = parsed_records(self.lines.filter(sh.not_blank()))
        kind = record_type(records)
        bad = F.col(RECORD).isNull()
        seen = Observation()
        observed = records.observe(seen, F.count_if(bad).alias("bad"))
        counts = self._put(self._gathered(typed(observed.filter(~bad), kind)), f"{self.target}/_inferred/{self.dataset}")
        counts["quarantined"] = seen.get["bad"]
        if counts["quarantined"]:
            lines = records.filter(bad).select("file_path", F.col("value").alias("line"))
            write_shredded(lines, self.quarantine, lookup=())
        return counts


def ingest(spark: SparkSession, landing: str, target: str, options: IngestOptions | None = None,
           selections: dict[str, str] | None = None, names: dict[str, str] | None = None) -> dict[str, IngestResult]:
    """Ingest every directory group found under a landing area: ``aa*/<group>/<files>``.

    ``selections`` and ``names`` are selection documents of earlier runs by group, see :func:`ingest_group`.
    """
    o = options or IngestOptions()
    listing = landing_files(spark, landing, o.min_file_bytes)
    groups = sorted(r["dataset_group"] for r in listing.select("dataset_group").distinct().collect())
    return {
        g: ingest_group(spark, listing.filter(F.col("dataset_group") == g), f"{target}/{g}", g, o,
                        (selections or {}).get(g), (names or {}).get(g)) for g in groups
    }


def dataset_totals(lines: DataFrame) -> DataFrame:
    """Parsed and unparsed lines per dataset, without the paths."""
    return record_totals(count_paths(lines))
