"""Sources, sinks, shredding and layout (S*, X*), with the SQL each must agree with.

Queries that go through files write them with Spark under the session's shared scratch folder and read them
back, so their work grows with the tables.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import functions as F

from checks.index_checks import ID as LOOKED_UP
from checks.index_checks import SQL as INDEX_SQL
from checks.raw import raw_lines, raw_sql
from checks.records import S, U, documents, records, records_sql
from quire.operators import layout
from quire.operators import shred as sh
from quire.operators.fields import select_fields
from quire.operators.paths import profile
from quire.operators.shred import Field
from quire.plans.ingest import IngestOptions, fields_for, ingest_group
from quire.plans.search_index import file_sizes, id_lookup
from quire.session import scratch_path
from quire.sources import landing, readers, seekable, sinks, zones
from quire.sources.files import move

_FUD, _SOF = "_source.file_unified_data", "_source.search_only_fields"
SEARCH_FIELDS = [
    Field.of("_source"),
    Field.of("_id"),
    Field.of(f"{_FUD}.title_best"),
    Field.of(f"{_FUD}.author_best"),
    Field.of(f"{_FUD}.year_best"),
    Field.of(f"{_FUD}.filesize_best"),
    Field.of(f"{_FUD}.journal"),
    Field.of(f"{_FUD}.journal.issn"),
    Field.of(f"{_FUD}.journal.volume.no"),
    Field.of(f"{_FUD}.lending[0][0].until"),
    Field.of(f"{_FUD}.classifications_unified"),
    Field.of(f"{_FUD}.classifications_unified.oclc_holdings"),
    Field.of(f"{_FUD}.classifications_unified.seldom"),
    Field.of(f"{_FUD}.editions"),
    Field.of(f"{_FUD}.editions[0].year"),
    Field.of(f"{_FUD}.editions[0].tags[0]"),
    Field.of(f"{_SOF}.search_text"),
    Field.of(f"{_SOF}.search_year"),
]
AAC_FIELDS = [
    Field.of("metadata"),
    Field.of("metadata.title"),
    Field.of("metadata.pages"),
    Field.of("metadata.isbn"),
    Field.of("metadata.nested[0][0].deep"),
    Field.of("metadata.a.b_c"),
    Field.of("metadata.a_b.c", "metadata_a_b_c__2"),
    Field.of("data_folder"),
]
_SHARED_COLUMNS = [f"{U}_title_best", f"{U}_content_type_best", f"{U}_filesize_best", "dataset", "_id"]


def _lines(spark, sf_dir, aac: bool):
    return raw_lines(spark, sf_dir).filter(F.col("dataset").startswith("aac_") == F.lit(aac))


def _search_records(spark, sf_dir):
    return sh.parse_search_lines(_lines(spark, sf_dir, aac=False))


def _aac_records(spark, sf_dir):
    return sh.parse_aac_lines(_lines(spark, sf_dir, aac=True))


def parts_for(spark, sf_dir, least, text_bytes=32 * 1024 * 1024):
    """Tasks to deal what is made of ``documents`` to: at least ``least``, and more as their texts grow, so that neither a
    task nor a file that it writes does."""
    total = documents(spark, sf_dir).agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    return max(least, math.ceil(total / text_bytes))


def _written_lines(spark, sf_dir, codec):
    path = scratch_path(spark, "lines")
    raw_lines(spark, sf_dir).select("dataset", "value").write.option("compression", codec).partitionBy(
        "dataset"
    ).text(path)
    return path


def _read_back(codec):
    def run(spark, sf_dir):
        path = _written_lines(spark, sf_dir, codec)
        lines = readers.read_lines(spark, f"{path}/*/*", partitions=parts_for(spark, sf_dir, 8))
        stats = lines.withColumn("set", F.regexp_extract("file_path", "dataset=([^/]+)/", 1))
        return layout.line_stats(stats, by="set").drop("avg_bytes_per_line")

    return run


def write_zstd_lines(lines, path):
    """Lines as zstd files named like container dumps, one per dataset and task (Spark has no zstd text sink).

    Each task writes files of its own number, so a retried task replaces what its first attempt left.
    """
    uri = path if "://" in path else f"file://{path}"

    def write(batches):
        import pyarrow.compute as pc
        from pyarrow import RecordBatch, fs
        from pyspark import TaskContext

        files, root = fs.FileSystem.from_uri(uri)
        files.create_dir(root, recursive=True)
        part, n, streams = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for dataset in pc.unique(batch.column("dataset")).to_pylist():
                name = f"public_meta__aacid__{dataset}__{part:05d}.jsonl.seekable.zst"
                if name not in streams:
                    streams[name] = files.open_output_stream(f"{root}/{name}", compression="zstd")
                own = batch.filter(pc.equal(batch.column("dataset"), dataset)).column("value").to_pylist()
                streams[name].write(("\n".join(own) + "\n").encode())
                n += len(own)
        for stream in streams.values():
            stream.close()
        yield RecordBatch.from_pydict({"n": [n]})

    return lines.select("dataset", "value").mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0]


def _read_zstd(spark, sf_dir):
    path = scratch_path(spark, "zstd")
    write_zstd_lines(readers.spread(raw_lines(spark, sf_dir), parts_for(spark, sf_dir, 4)), path)
    lines = readers.read_lines(spark, f"{path}/*.zst")
    return layout.line_stats(lines, by="dataset").drop("avg_bytes_per_line")


def _listing(spark, path):
    """Listing of the files written under ``dataset=<name>`` directories."""
    files = landing.list_files(spark, path)
    return files.filter(~F.col("file_name").startswith("_")).withColumn(
        "dataset", F.regexp_replace("directory", "^dataset=", "")
    )


def write_seekable_lines(lines, path, frame_lines=200):
    """Lines as zstd files of many frames with a seek table at the end, one per dataset and task."""
    uri = path if "://" in path else f"file://{path}"

    def write(batches):
        import struct

        import zstandard
        from pyarrow import RecordBatch, fs
        from pyspark import TaskContext

        files, root = fs.FileSystem.from_uri(uri)
        files.create_dir(root, recursive=True)
        part, n, held = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for dataset, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(dataset, []).append(line)
        for dataset, own in sorted(held.items()):
            entries = b""
            with files.open_output_stream(f"{root}/public_meta__aacid__{dataset}__{part:05d}.jsonl.seekable.zst", compression=None) as f:
                for lo in range(0, len(own), frame_lines):
                    text = "".join(line + "\n" for line in own[lo:lo + frame_lines]).encode()
                    frame = zstandard.ZstdCompressor().compress(text)
                    f.write(frame)
                    entries += struct.pack("<II", len(frame), len(text))
                footer = struct.pack("<IBI", len(entries) // 8, 0, 0x8F92EAB1)
                f.write(struct.pack("<II", 0x184D2A5E, len(entries) + len(footer)) + entries + footer)
            n += len(own)
        yield RecordBatch.from_pydict({"n": [n]})

    return lines.select("dataset", "value").mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0]


def _read_seekable(spark, sf_dir):
    """Files of many frames, each read by several tasks."""
    path = scratch_path(spark, "seekable")
    write_seekable_lines(readers.spread(raw_lines(spark, sf_dir), parts_for(spark, sf_dir, 4)), path, frame_lines=50)
    paths = [r["path"].replace("file:/", "/", 1) if r["path"].startswith("file:/") else r["path"]
             for r in landing.list_files(spark, path, "*.zst").select("path").collect()]
    lines = seekable.read_seekable_lines(spark, paths, target_bytes=100_000)
    return layout.line_stats(lines, by="dataset").drop("avg_bytes_per_line")


def _zone_lookup(spark, sf_dir):
    """Q03 over a clustered table, by way of its zone map."""
    path = scratch_path(spark, "clustered")
    zones.write_clustered(records(spark, sf_dir), path, "_id", parts_for(spark, sf_dir, 16))
    return id_lookup(zones.lookup(spark, path, "_id", [LOOKED_UP]), LOOKED_UP)


def _landing(spark, sf_dir):
    """Lines written as ``aa<n>/<group>/`` files; the selection must keep exactly the right ones."""
    base = scratch_path(spark, "torrent")
    lines = raw_lines(spark, sf_dir)
    aac, aux = F.col("dataset").startswith("aac_"), F.col("dataset").isin("metadata", "journals", "digital_lending")
    folders = {"aa2024/elasticsearch": ~aac & ~aux, "aa2024/elasticsearchaux": aux, "bb2024/elasticsearch": ~aac,
               "aa2024/other": ~aac}
    for folder, chosen in folders.items():
        lines.filter(chosen).select("value").write.option("compression", "gzip").text(f"{base}/{folder}")
    write_zstd_lines(lines.filter(aac), f"{base}/aa2024/aac")
    (spark.range(1).select(F.lit("{}").alias("value")).write.option("compression", "gzip")
     .mode("append").text(f"{base}/aa2024/elasticsearch"))  # below the smallest size
    kept = landing.landing_files(spark, base, min_bytes=100)
    paths = kept.select(F.col("path").alias("kept"), "dataset_group").collect()  # one row a file
    group = {r["kept"]: r["dataset_group"] for r in paths}
    parts = [readers.read_lines(spark, [p for p, g in group.items() if g == name]).select(F.lit(name).alias("dataset_group"))
             for name in sorted(set(group.values()))]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("dataset_group").agg(F.count(F.lit(1)).alias("n_lines"))


def _inferred(spark, sf_dir):
    path = scratch_path(spark, "auto")
    whole = raw_lines(spark, sf_dir, damage=False)
    whole.filter(~F.col("dataset").startswith("aac_")).select("value").write.text(path)
    df = readers.read_inferred(spark, path)
    return df.groupBy(F.col("_source.file_unified_data.author_best").alias("author")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_source.file_unified_data.filesize_best").alias("bytes")
    )


def _variant(spark, sf_dir):
    path = scratch_path(spark, "auto")
    raw_lines(spark, sf_dir, damage=False).select("value").write.text(path)
    df = readers.read_inferred(spark, path, as_variant=True)
    title = F.coalesce(
        F.try_variant_get("record", "$._source.file_unified_data.title_best", "string"),
        F.try_variant_get("record", "$.metadata.title", "string"),
    )
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(title).cast("bigint")).alias("title_bytes"))


# Texts in a task that writes the files of three datasets or bases, of about a third of its bytes each: small files.
SMALL_TEXTS = 6 * 1024 * 1024


def _written_records(spark, sf_dir, n=12):
    """The shredded table as small Parquet files, at least ``n`` and more as it grows, one directory per dataset."""
    path = scratch_path(spark, "shredded")
    rows = readers.spread(records(spark, sf_dir), parts_for(spark, sf_dir, n, SMALL_TEXTS))
    counts = sinks.write_shredded(rows, path, partition_by=["dataset"])
    return path, counts


def _summary(df, by="dataset"):
    return df.groupBy(F.col(by).alias("set")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("_id").alias("n_ids"),
        F.sum(F.octet_length(f"{U}_title_best").cast("bigint")).alias("title_bytes"),
    )


def _scan_round_trip(spark, sf_dir):
    path, _ = _written_records(spark, sf_dir)
    return _summary(readers.read_shredded(spark, path))


def _scan_file_list(spark, sf_dir):
    path, _ = _written_records(spark, sf_dir)
    files = [r["path"] for r in landing.list_files(spark, path, "*.parquet").select("path").collect()]
    df = readers.read_shredded(spark, *files)
    return _summary(df.withColumn("set", F.regexp_extract("_metadata.file_path", "dataset=([^/]+)/", 1)), "set")


def _rows_per_file(spark, sf_dir):
    path, _ = _written_records(spark, sf_dir)
    per_file = readers.file_rows(spark, path)
    name = F.regexp_extract("file_path", "dataset=([^/]+)/", 1)
    return per_file.groupBy(name.alias("set")).agg(F.sum("n_rows").alias("n_rows"))


def _row_counts_on_write(spark, sf_dir):
    """What lies in the files, beside the number that the write itself reported."""
    path, counts = _written_records(spark, sf_dir)
    found = _summary(readers.read_shredded(spark, path))
    return found.withColumn("rows_written", F.lit(counts["rows"]).cast("bigint"))


def _compacted(by, target_bytes):
    """What each dataset holds after its files were merged (each is about a megabyte, mostly bloom filter)."""

    def run(spark, sf_dir):
        path, _ = _written_records(spark, sf_dir)
        out = scratch_path(spark, "compact")
        files = landing.list_files(spark, path, "*.parquet")
        report = layout.compact(spark, files, out, target_bytes=target_bytes, by=by)
        fewer = F.lit(report["files_out"] < report["files_in"])
        return _summary(readers.read_shredded(spark, out)).withColumn("fewer_files", fewer)

    return run


def _foreign_files(spark, sf_dir):
    """Shredded files in one folder, named as other tools number them: ``<dataset>_<source>_<n>.parquet``.

    Returns the folder and the rows' dataset by the base of their file."""
    made, path = scratch_path(spark, "made"), scratch_path(spark, "foreign")
    kind = {"set0": "metadata", "set1": "records", "set2": "aac_duxiu"}
    name = F.concat(F.element_at(F.create_map(*[F.lit(x) for kv in kind.items() for x in kv]), F.col("dataset")), F.lit("_x"))
    rows = readers.spread(records(spark, sf_dir).withColumn("base", name), parts_for(spark, sf_dir, 6, SMALL_TEXTS))
    sinks.write_shredded(rows, made, partition_by=["base"])
    numbers: dict[str, int] = {}
    for r in landing.list_files(spark, made, "*.parquet").orderBy("path").collect():  # one row a file
        base = r["directory"].removeprefix("base=")
        numbers[base] = numbers.get(base, -1) + 1
        move(spark, r["path"], f"{path}/{base}_{numbers[base]}.parquet")
    return path


def _compacted_by_base(spark, sf_dir):
    """What each base holds after the numbered files of all bases, in one folder, were merged."""
    path, out = _foreign_files(spark, sf_dir), scratch_path(spark, "compact")
    report = layout.compact(spark, landing.list_files(spark, path, "*.parquet"), out, target_bytes=4 * 1024 * 1024, by="base")
    fewer = F.lit(report["files_out"] < report["files_in"])
    return _summary(readers.read_shredded(spark, out), "base").withColumn("fewer_files", fewer)


def _merge_patterns(spark, sf_dir):
    """Each group's name pattern picks its own files out of a folder that holds those of all."""
    path, parts = _foreign_files(spark, sf_dir), []
    for group in landing.GROUPS:
        files = [r["path"] for r in readers.merge_candidates(spark, path, group).select("path").collect()]
        rows = readers.read_shredded(spark, *files)
        parts.append(rows.agg(F.lit(group).alias("dataset_group"), F.count(F.lit(1)).alias("n_rows"),
                              F.count_distinct("dataset").alias("n_datasets")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _compacted_hot(spark, sf_dir):
    """Line items by ship mode and with one mode that holds most of them, in several files each, merged."""
    path, out = scratch_path(spark, "lineitem"), scratch_path(spark, "compact")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    mode = F.when(F.col("l_orderkey") % 10 < 8, "MOST").otherwise(F.col("l_returnflag"))
    parts = max(8, math.ceil(items.count() / 500_000))  # so that a task's sort by mode does not grow with the table
    readers.spread(items.withColumn("mode", mode), parts).write.partitionBy("mode").parquet(path)
    files = landing.list_files(spark, path, "*.parquet")
    layout.compact(spark, files, out, target_bytes=256 * 1024)
    return readers.read_shredded(spark, out).groupBy("mode").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_orderkey")).alias("keys"))


def _merge_candidates(spark, sf_dir):
    """Nothing carries the group's name pattern here, so every Parquet file is a candidate."""
    path, _ = _written_records(spark, sf_dir)
    files = readers.merge_candidates(spark, path, "elasticsearchaux").select("path").collect()
    return readers.read_shredded(spark, *[r["path"] for r in files]).agg(F.count(F.lit(1)).alias("n_rows"))


def _table_summary(spark, result):
    """What lies in each dataset's table, beside what the run reported."""
    out = []
    for dataset, path in result.tables.items():
        df = readers.read_shredded(spark, path)
        key = "aacid" if dataset.startswith("aac_") else "_id"
        title = "metadata_title" if dataset.startswith("aac_") else f"{U}_title_best"
        counts = result.counts[dataset]
        out.append(df.agg(
            F.lit(dataset).alias("dataset"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(key).alias("n_ids"),
            F.sum(F.octet_length(title).cast("bigint")).alias("title_bytes"),
            F.lit(counts["rows"]).cast("bigint").alias("rows_written"),
            F.lit(counts["quarantined"]).cast("bigint").alias("quarantined"),
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        ))
    return reduce(lambda x, y: x.unionByName(y), out)


def _ingested(spark, sf_dir):
    """Compressed lines to shredded tables, the whole way, for the group whose fields are combined."""
    listing = _listing(spark, _written_lines(spark, sf_dir, "gzip"))
    result = ingest_group(spark, listing, scratch_path(spark, "ingest"), "elasticsearchaux", IngestOptions(sample_rate=1.0))
    return _table_summary(spark, result)


def _ingested_from_a_sample(spark, sf_dir):
    """The same from a profile of a fifth of the rows: fewer columns may be found, no row is lost."""
    listing = _listing(spark, _written_lines(spark, sf_dir, "gzip"))
    result = ingest_group(spark, listing, scratch_path(spark, "ingest"), "elasticsearchaux", IngestOptions(sample_rate=0.2))
    return _table_summary(spark, result).drop("n_columns")


def _ingested_again(spark, sf_dir):
    """A second run over whole lines, from the selection that a first run over damaged ones stored."""
    o = IngestOptions(sample_rate=1.0)
    listing = _listing(spark, _written_lines(spark, sf_dir, "gzip"))
    first = ingest_group(spark, listing, scratch_path(spark, "ingest"), "elasticsearchaux", o)
    whole = scratch_path(spark, "whole")
    raw_lines(spark, sf_dir, damage=False).select("dataset", "value").write.option("compression", "gzip").partitionBy(
        "dataset").text(whole)
    again = ingest_group(spark, _listing(spark, whole), scratch_path(spark, "ingest"), "elasticsearchaux", o,
                         selection=first.selection_path)
    return _table_summary(spark, again)


def _quarantined_lines(spark, sf_dir):
    """The lines of all six datasets that an ingest set aside."""
    listing = _listing(spark, _written_lines(spark, sf_dir, "gzip"))
    target = scratch_path(spark, "ingest")
    result = ingest_group(spark, listing, target, "elasticsearch", IngestOptions(sample_rate=1.0))
    parts = [spark.read.parquet(f"{target}/_quarantine/{d}").select(F.lit(d).alias("dataset"), "line")
             for d, counts in result.counts.items() if counts["quarantined"]]
    return reduce(lambda x, y: x.unionByName(y), parts)


def _quarantined_files(spark, sf_dir):
    """All or nothing by file, for all six datasets: rows kept and lines set aside, as they lie there."""
    path, target = scratch_path(spark, "files"), scratch_path(spark, "ingest")
    # one file of lines for each file name, so that what is set aside is what the names say
    # (by ranges: hashes would send several names to one task)
    lines = raw_lines(spark, sf_dir).select("dataset", "file_name", "value").repartitionByRange(96, "dataset", "file_name")
    lines.write.option("compression", "gzip").partitionBy("dataset", "file_name").text(path)
    files = landing.list_files(spark, path).filter(~F.col("file_name").startswith("_")).withColumn(
        "dataset", F.regexp_extract("path", "dataset=([^/]+)/", 1))
    result = ingest_group(spark, files, target, "elasticsearch", IngestOptions(sample_rate=1.0, quarantine="file"))
    parts = []
    for dataset, counts in result.counts.items():
        kept = readers.read_shredded(spark, result.tables[dataset]).select(F.lit(1).alias("kept"))
        if counts["quarantined"]:
            aside = spark.read.parquet(f"{target}/_quarantine/{dataset}").select(F.lit(0).alias("kept"))
            kept = kept.unionByName(aside)
        parts.append(kept.groupBy(F.lit(dataset).alias("dataset")).agg(
            F.count_if(F.col("kept") == 1).alias("n_rows"), F.count_if(F.col("kept") == 0).alias("n_set_aside")))
    return reduce(lambda x, y: x.unionByName(y), parts)


# What makes some lines lose something although they parse; both engines replace the same texts.
_SPOILED = (
    "case when doc_id % 7 = 1 then replace({0}, '\"_score\":', '\"_score\":\"abc\",\"was\":')"
    " when doc_id % 7 = 2 then replace({0}, '\"_source\":{{', '\"_source\":\"text\",\"rest\":{{')"
    " when doc_id % 7 = 3 then replace(replace({0}, '{{\"_index\":', '{{\"_id\":\"first\",\"_index\":'), '{{\"aacid\":',"
    " '{{\"aacid\":\"first\",\"aacid\":')"
    " when doc_id % 7 = 4 then replace({0}, '\"metadata\":{{', '\"metadata\":[1],\"rest\":{{') else {0} end"
)


def _defects(spark, sf_dir):
    """What good records lose, as counted by the parse itself."""
    lines = raw_lines(spark, sf_dir).withColumn("value", F.expr(_SPOILED.format("value")))
    aac = F.col("dataset").startswith("aac_")
    keep = ["dataset", sh.DEFECTS, sh.CORRUPT]
    parsed = sh.parse_search_lines(lines.filter(~aac), ledger=True).select(*keep).unionByName(
        sh.parse_aac_lines(lines.filter(aac), ledger=True).select(*keep))
    return parsed.groupBy("dataset").agg(F.count_if(F.col(sh.CORRUPT).isNotNull()).alias("corrupt"),
                                         *[F.count_if(sh.has_defect(n)).alias(n) for n in sh.DEFECT_BITS])


_UNKNOWN = ("concat('{{\"id\":', cast(doc_id as string), ',\"lang\":\"', lang, '\",\"size\":{{\"chars\":',"
            " cast(n_chars as string), '}},\"tags\":[\"', source, '\"]', case when doc_id % 5 = 0 then '' else '}}' end)").replace(
                "{{", "{").replace("}}", "}")


def _fallback(spark, sf_dir):
    """Records of a dataset that no selected field fits: typed by what they hold, in a folder of their own."""
    path = scratch_path(spark, "unknown")
    documents(spark, sf_dir).select(F.expr(_UNKNOWN).alias("value")).write.option("compression", "gzip").text(
        f"{path}/dataset=other")
    result = ingest_group(spark, _listing(spark, path), scratch_path(spark, "ingest"), "elasticsearch",
                          IngestOptions(sample_rate=1.0))
    df = readers.read_shredded(spark, result.inferred["other"])
    return df.groupBy("lang", F.col("tags")[0].alias("tag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size.chars").alias("chars"), F.sum("id").alias("ids"),
        F.first(F.lit(result.counts["other"]["quarantined"]).cast("bigint")).alias("quarantined"))


def profile_shred_query(spark, sf_dir):
    """From raw lines to a report: profile, select, shred, and file sizes by content type."""
    lines = _lines(spark, sf_dir, aac=False)
    stored = scratch_path(spark, "profile")
    sinks.write_report(profile(lines.select(F.lit("records").alias("dataset"), "value")), stored)
    selected = select_fields(spark.read.parquet(stored))
    chosen = fields_for(selected, "elasticsearch")["records"]
    table = sh.shred_search(sh.parse_search_lines(lines, fields=chosen), chosen)
    return file_sizes(table, min_count=0)


def _parts(spark, sf_dir):
    docs = documents(spark, sf_dir).select("source", "doc_id", "text")
    parts = layout.assign_parts(docs, "source", "doc_id", layout.line_bytes("text"), target_bytes=16_384)
    return parts.select("source", "doc_id", "part")


def _resized(spark, sf_dir):
    lines = layout.resize(raw_lines(spark, sf_dir).select("dataset", "value"), target_bytes=64 * 1024)
    return layout.line_stats(lines, by="dataset").withColumn(
        "avg_bytes_per_line", F.round("avg_bytes_per_line", 2)
    )


QUERIES = {
    "S01_gzip_lines": _read_back("gzip"),
    "S02_zstd_lines": _read_zstd,
    "S02_seekable_lines": _read_seekable,
    "S03_landing_files": _landing,
    "S04_dataset_of_file": lambda s, d: raw_lines(s, d).select("doc_id", landing.dataset_of("file_name").alias("dataset")),
    "S05_group_of_directory": lambda s, d: documents(s, d).select(
        "doc_id", landing.group_of(F.concat("source", F.lit("_elasticsearch"), F.substring("lang", 1, 1), F.lit("ux")))
        .alias("dataset_group")
    ),
    "S06_parts_by_size": _parts,
    "S06_resized_lines": _resized,
    "S07_line_stats": lambda s, d: layout.line_stats(documents(s, d), by="source", value="text").withColumn(
        "avg_bytes_per_line", F.round("avg_bytes_per_line", 2)
    ),
    "S08_lenient_read": lambda s, d: _search_records(s, d).select("doc_id", "_index", "_id", "_score"),
    "S09_inferred_read": _inferred,
    "S09_variant_read": _variant,
    "S10_parquet_directory": _scan_round_trip,
    "S11_parquet_file_list": _scan_file_list,
    "S12_rows_per_file": _rows_per_file,
    "S13_zstd_parquet_write": _row_counts_on_write,
    "S13_zone_lookup": _zone_lookup,
    "S16_quarantine_rows": lambda s, d: sh.quarantined(_search_records(s, d)).select("doc_id", sh.CORRUPT),
    "S16_quarantine_files": lambda s, d: sh.quarantined(_aac_records(s, d), "file").select("doc_id", "file_path"),
    "S16_accepted_files": lambda s, d: sh.accepted(_aac_records(s, d), "file").select("doc_id", "file_path"),
    "S17_base_names": lambda s, d: raw_lines(s, d).select(
        landing.base_name(F.concat("dataset", F.lit("_"), F.regexp_replace("file_name", r"\..*$", ""), F.lit("_"),
                                   F.col("doc_id").cast("string"), F.lit(".parquet"))).alias("base")
    ).groupBy("base").agg(F.count(F.lit(1)).alias("n_files")),
    "S09_ingest_fallback": _fallback,
    "S16_ingest_quarantine": _quarantined_lines,
    "S16_ingest_quarantine_files": _quarantined_files,
    "S18_compaction_by_base": _compacted_by_base,
    "S18_compaction_by_directory": _compacted("directory", 4 * 1024 * 1024),
    "S18_compaction_no_shuffle": _compacted("none", 1024 * 1024),
    "S18_compaction_hot_base": _compacted_hot,
    "S19_merge_candidates": _merge_candidates,
    "S19_merge_patterns": _merge_patterns,
    "X01_defects": _defects,
    "X01_shred_search": lambda s, d: sh.shred_search(_search_records(s, d), SEARCH_FIELDS),
    "X01_shred_search_one_pass": lambda s, d: sh.shred_search(
        sh.parse_search_lines(_lines(s, d, aac=False), fields=SEARCH_FIELDS), SEARCH_FIELDS
    ),
    "X01_shred_search_keep_corrupt": lambda s, d: sh.shred_search(
        _search_records(s, d), SEARCH_FIELDS, keep=["doc_id"], keep_corrupt=True
    ),
    "X02_shred_aac": lambda s, d: sh.shred_aac(_aac_records(s, d), AAC_FIELDS),
    "X04_ingest": _ingested,
    "X04_ingest_sampled": _ingested_from_a_sample,
    "X04_ingest_from_selection": _ingested_again,
    "X04_profile_shred_query": profile_shred_query,
}


def _json_columns(fields, root):
    columns = []
    for f in fields:
        if f.path.startswith(root + "."):
            columns.append(f"j ->> '$.{f.path}' AS \"{f.column}\"")
    return ",\n  ".join(columns)


_IS_AAC = "dataset LIKE 'aac\\_%' ESCAPE '\\'"
_ENVELOPE = "j ->> '$._index' AS _index, j ->> '$._id' AS _id, (j ->> '$._score')::DOUBLE AS _score"
_LINE_STATS = "count(*) AS n_lines, sum(strlen(value) + 1)::BIGINT AS n_bytes"
_SUMMARY = f"count(*) AS n_rows, count(DISTINCT _id) AS n_ids, sum(strlen({U}_title_best))::BIGINT AS title_bytes"
_BAD_FILES = "(SELECT DISTINCT file_path FROM raw WHERE NOT json_valid(value))"

SQL = {
    "S01_gzip_lines": f"{raw_sql()}\nSELECT dataset AS \"set\", {_LINE_STATS} FROM raw GROUP BY 1",
    "S03_landing_files": f"""{raw_sql()}
SELECT CASE WHEN {_IS_AAC} THEN 'aac' WHEN dataset = 'records' THEN 'elasticsearch' ELSE 'elasticsearchaux' END
  AS dataset_group, count(*) AS n_lines FROM raw GROUP BY 1""",
    "S04_dataset_of_file": f"{raw_sql()}\nSELECT doc_id, dataset FROM raw",
    "S05_group_of_directory": """SELECT doc_id, CASE WHEN substr(lang, 1, 1) = 'a' THEN 'elasticsearchaux'
  ELSE 'elasticsearch' END AS dataset_group FROM documents""",
    "S06_parts_by_size": """SELECT source, doc_id, ((cum - 1) // 16384 + 1)::BIGINT AS part FROM (
  SELECT source, doc_id, sum(strlen(text) + 1) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS cum FROM documents)""",
    "S06_resized_lines": f"""{raw_sql()}
SELECT dataset, {_LINE_STATS}, round(avg(strlen(value) + 1), 2) AS avg_bytes_per_line FROM raw GROUP BY 1""",
    "S07_line_stats": """SELECT source, count(*) AS n_lines, sum(strlen(text) + 1)::BIGINT AS n_bytes,
  round(avg(strlen(text) + 1), 2) AS avg_bytes_per_line FROM documents GROUP BY 1""",
    "S08_lenient_read": f"""{raw_sql()}
SELECT r.doc_id, {_ENVELOPE} FROM raw r LEFT JOIN valid v ON r.doc_id = v.doc_id WHERE NOT (r.{_IS_AAC})""",
    "S09_inferred_read": f"""{raw_sql()}
SELECT j ->> '$._source.file_unified_data.author_best' AS author, count(*) AS n,
  sum((j ->> '$._source.file_unified_data.filesize_best')::BIGINT)::BIGINT AS bytes
FROM (SELECT dataset, whole::JSON AS j FROM built) WHERE NOT ({_IS_AAC}) GROUP BY 1""",
    "S09_variant_read": "SELECT count(*) AS n, sum(strlen(text))::BIGINT AS title_bytes FROM documents",
    "S10_parquet_directory": f'{records_sql()}SELECT dataset AS "set", {_SUMMARY} FROM records GROUP BY 1',
    "S12_rows_per_file": f'{records_sql()}SELECT dataset AS "set", count(*) AS n_rows FROM records GROUP BY 1',
    "S13_zstd_parquet_write": f"""{records_sql()}SELECT dataset AS "set", {_SUMMARY},
  (SELECT count(*) FROM documents) AS rows_written FROM records GROUP BY 1""",
    "S16_quarantine_rows": f"""{raw_sql()}
SELECT doc_id, value AS _corrupt_record FROM raw WHERE NOT json_valid(value) AND NOT ({_IS_AAC})""",
    "S16_quarantine_files": f"""{raw_sql()}
SELECT doc_id, file_path FROM raw WHERE {_IS_AAC} AND file_path IN {_BAD_FILES}""",
    "S16_accepted_files": f"""{raw_sql()}
SELECT doc_id, file_path FROM raw WHERE {_IS_AAC} AND file_path NOT IN {_BAD_FILES}""",
    "S17_base_names": f"""{raw_sql()}
SELECT dataset || '_' || regexp_replace(file_name, '\\..*$', '') AS base, count(*) AS n_files FROM raw GROUP BY 1""",
    "S18_compaction_by_directory": f'{records_sql()}SELECT dataset AS "set", {_SUMMARY}, true AS fewer_files FROM records GROUP BY 1',
    "S18_compaction_hot_base": """SELECT CASE WHEN l_orderkey % 10 < 8 THEN 'MOST' ELSE l_returnflag END AS mode,
  count(*) AS n_rows, sum(l_orderkey)::BIGINT AS keys FROM lineitem GROUP BY 1""",
    "S19_merge_candidates": "SELECT count(*) AS n_rows FROM documents",
    "X01_shred_search": f"""{raw_sql()}
SELECT {_ENVELOPE},
  {_json_columns(SEARCH_FIELDS, '_source')} FROM valid WHERE NOT ({_IS_AAC})""",
    "X01_shred_search_keep_corrupt": f"""{raw_sql()}
SELECT r.doc_id, {_ENVELOPE},
  {_json_columns(SEARCH_FIELDS, '_source')}
FROM raw r LEFT JOIN valid v ON r.doc_id = v.doc_id WHERE NOT (r.{_IS_AAC})""",
    "X02_shred_aac": f"""{raw_sql()}
SELECT j ->> '$.aacid' AS aacid, j ->> '$.metadata' AS metadata,
  {_json_columns(AAC_FIELDS, 'metadata')} FROM valid WHERE {_IS_AAC}""",
}
SQL["X04_profile_shred_query"] = f"""{raw_sql()}
SELECT content_type, count(*) AS count, round(avg(mb), 2) AS avg_size_mb, round(min(mb)::DOUBLE, 2) AS min_size_mb,
  round(max(mb)::DOUBLE, 2) AS max_size_mb
FROM (SELECT j ->> '$._source.file_unified_data.content_type_best' AS content_type,
    try_cast(j ->> '$._source.file_unified_data.filesize_best' AS FLOAT) / 1048576 AS mb FROM valid WHERE NOT ({_IS_AAC}))
GROUP BY 1"""
SQL["X01_shred_search_one_pass"] = SQL["X01_shred_search"]
SQL["X04_ingest"] = f"""{raw_sql()},
fields AS (SELECT dataset, replace(regexp_replace(t.fullkey, '^\\$\\.', ''), '"', '') AS path, count(*) AS n
  FROM valid, json_tree(valid.j) t WHERE t.key IS NOT NULL AND NOT regexp_matches(t.fullkey, '\\[[1-9][0-9]*\\]')
    AND NOT regexp_matches(t.fullkey, '\\]$') GROUP BY 1, 2),
totals AS (SELECT dataset, count(*) AS total FROM valid GROUP BY 1),
aux AS (SELECT unnest(['metadata', 'journals', 'digital_lending']) AS dataset),
common AS (SELECT dataset, path FROM fields JOIN totals USING (dataset) WHERE n >= total * 0.2),
chosen AS (SELECT dataset, path FROM common WHERE dataset NOT IN (FROM aux) UNION
  SELECT aux.dataset, common.path FROM aux, common WHERE common.dataset IN (FROM aux)),
widths AS (SELECT dataset, count(*) + CASE WHEN {_IS_AAC} THEN 2 ELSE 3 END AS n_columns FROM chosen
  WHERE path LIKE CASE WHEN {_IS_AAC} THEN 'metadata.%' ELSE '\\_source.%' END ESCAPE '\\' GROUP BY 1)
SELECT dataset, count(*) FILTER (ok) AS n_rows, count(DISTINCT doc_id) FILTER (ok) AS n_ids,
  sum(strlen(text)) FILTER (ok)::BIGINT AS title_bytes, count(*) FILTER (ok) AS rows_written,
  count(*) FILTER (NOT ok) AS quarantined, any_value(n_columns) AS n_columns
FROM (SELECT raw.dataset, raw.doc_id, text, json_valid(value) AS ok FROM raw JOIN documents USING (doc_id))
JOIN widths USING (dataset) GROUP BY 1"""
SQL["S02_zstd_lines"] = f"{raw_sql()}\nSELECT 'aac_' || dataset AS dataset, {_LINE_STATS} FROM raw GROUP BY 1"
SQL["S11_parquet_file_list"] = SQL["S10_parquet_directory"]
SQL["S18_compaction_no_shuffle"] = SQL["S18_compaction_by_directory"]
_BASE = "CASE dataset WHEN 'set0' THEN 'metadata_x' WHEN 'set1' THEN 'records_x' ELSE 'aac_duxiu_x' END"
SQL["S18_compaction_by_base"] = f'{records_sql()}SELECT {_BASE} AS "set", {_SUMMARY}, true AS fewer_files FROM records GROUP BY 1'
SQL["S19_merge_patterns"] = f"""{records_sql()}SELECT CASE dataset WHEN 'set0' THEN 'elasticsearchaux' WHEN 'set1' THEN 'elasticsearch'
  ELSE 'aac' END AS dataset_group, count(*) AS n_rows, count(DISTINCT dataset) AS n_datasets FROM records GROUP BY 1"""
SQL["S16_ingest_quarantine"] = f"{raw_sql()}\nSELECT dataset, value AS line FROM raw WHERE NOT json_valid(value)"
SQL["S16_ingest_quarantine_files"] = f"""{raw_sql()},
bad AS (SELECT DISTINCT dataset, file_path FROM raw WHERE NOT json_valid(value))
SELECT dataset, count(*) FILTER ((dataset, file_path) NOT IN (SELECT (dataset, file_path) FROM bad)) AS n_rows,
  count(*) FILTER ((dataset, file_path) IN (SELECT (dataset, file_path) FROM bad)) AS n_set_aside FROM raw GROUP BY 1"""
_ROOT = f"CASE WHEN {_IS_AAC} THEN '$.metadata' ELSE '$._source' END"
SQL["X01_defects"] = f"""{raw_sql()},
spoiled AS (SELECT dataset, {_SPOILED.format('value')} AS value FROM raw),
good AS (SELECT dataset, value::JSON AS j FROM spoiled WHERE json_valid(value))
SELECT dataset, (SELECT count(*) FROM spoiled s WHERE s.dataset = good.dataset AND NOT json_valid(s.value)) AS corrupt,
  count(*) FILTER (NOT {_IS_AAC} AND json_type(j, '$._score') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')) AS lost_score,
  count(*) FILTER (json_type(j, {_ROOT}) NOT IN ('OBJECT', 'NULL')) AS body_no_object,
  count(*) FILTER (len(json_keys(j)) > len(list_distinct(json_keys(j)))) AS repeated_key FROM good GROUP BY 1"""
SQL["S09_ingest_fallback"] = """SELECT lang, source AS tag, count(*) AS n, sum(n_chars)::BIGINT AS chars, sum(doc_id)::BIGINT AS ids,
  (SELECT count(*) FROM documents WHERE doc_id % 5 = 0) AS quarantined FROM documents WHERE doc_id % 5 <> 0 GROUP BY 1, 2"""
SQL["X04_ingest_sampled"] = SQL["X04_ingest"].replace(", any_value(n_columns) AS n_columns", "")
SQL["X04_ingest_from_selection"] = SQL["X04_ingest"].replace(
    "FROM (SELECT raw.dataset, raw.doc_id, text, json_valid(value) AS ok FROM raw", "FROM (SELECT raw.dataset, raw.doc_id, text, true AS ok FROM raw")
SQL["S02_seekable_lines"] = SQL["S02_zstd_lines"]
SQL["S13_zone_lookup"] = INDEX_SQL["Q03_id_lookup"]
