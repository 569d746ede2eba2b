"""Readers, landing selection, classification and sinks on small files."""

import gzip
import json

import zstandard
from pyspark.sql import functions as F

from quire.operators import fields as fl
from quire.operators import paths as pt
from quire.sources import landing, readers, sinks
from tests.conftest import plan_of

LINES = [json.dumps({"_id": str(i), "_source": {"t": "é" * i}}) for i in range(7)]
TEXT = ("\n".join(LINES) + "\n").encode()


def _zstd_two_frames(path):
    c = zstandard.ZstdCompressor()
    half = TEXT.index(b"\n", len(TEXT) // 2) + 1
    skippable = b"\x50\x2a\x4d\x18" + (8).to_bytes(4, "little") + b"seektabl"
    path.write_bytes(c.compress(TEXT[:half]) + c.compress(TEXT[half:]) + skippable)


def test_compressed_lines(spark, tmp_path):
    (tmp_path / "aarecords__0.json.gz").write_bytes(gzip.compress(TEXT))
    (tmp_path / "x_meta__aacid__duxiu__2024.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(TEXT))
    _zstd_two_frames(tmp_path / "x_meta__aacid__duxiu__2025.jsonl.seekable.zst")
    lines = readers.read_lines(spark, str(tmp_path))
    got = {r["dataset"]: r["n"] for r in lines.groupBy("dataset").agg(F.count("*").alias("n")).collect()}
    assert got == {"records": 7, "aac_duxiu": 14}
    assert sorted({r["value"] for r in lines.collect()}) == sorted(LINES)


def test_dataset_names(spark):
    names = {
        "aarecords__0.json.gz": "records",
        "aarecords_0.json.gz": "records",
        "aarecords__12.json.gz": "records",
        "aarecords_metadata__0.json.gz": "metadata",
        "aarecords_journals__3.json.gz": "journals",
        "aarecords_digital_lending__0.json.gz": "digital_lending",
        "copy_aarecords_journals__3.json.gz": "other",
        "aarecords__0.json": "other",
        "x_meta__aacid__zlib3_records__2024--2025.jsonl.seekable.zst": "aac_zlib3_records",
        "x_meta__aacid__ia2__a__b.jsonl.zst": "aac_ia2",
        "x_meta__aacid__ia2.jsonl.zst": "other",
    }
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", landing.dataset_of("n").alias("d"))
    assert {r["n"]: r["d"] for r in df.collect()} == names


def test_groups_and_base_names(spark):
    df = spark.createDataFrame([(n,) for n in ("elasticsearchaux", "elasticsearch_json", "aac_parts", "misc")], "n string")
    assert [r[0] for r in df.select(landing.group_of("n")).collect()] == ["elasticsearchaux", "elasticsearch", "aac", "misc"]
    names = {"metadata_journals_1.parquet": "metadata_journals", "a_b.parquet": "a_b", "7.parquet": "7",
             "x__12.parquet": "x_", "x_1_2.parquet": "x_1"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(landing.base_name("n")).collect()] == list(names.values())


def test_landing_files(spark, tmp_path):
    def put(path, size):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(b"x" * size)

    put("aa_2024/elasticsearch/aarecords__0.json.gz", 100)
    put("aa_2024/elasticsearch/small.json.gz", 99)
    put("aa_2024/elasticsearch/aarecords__1.json.zst", 500)
    put("aa_2024/elasticsearchaux/aarecords_journals__0.json.gz", 100)
    put("aa_2025/aac/x_meta__aacid__ia2__1.jsonl.seekable.zst", 100)
    put("aa_2025/aac/notes.gz", 500)
    put("bb_2025/aac/x_meta__aacid__ia2__2.jsonl.zst", 500)
    put("aa_2025/aac/deeper/x_meta__aacid__ia2__3.jsonl.zst", 500)
    rows = landing.landing_files(spark, str(tmp_path), min_bytes=100)
    assert sorted((r["dataset_group"], r["dataset"]) for r in rows.collect()) == [
        ("aac", "aac_ia2"), ("elasticsearch", "records"), ("elasticsearchaux", "journals"),
    ]
    assert "content" not in plan_of(rows).replace("pathGlobFilter", "")


def test_spread_decides_from_sizes():
    mb = 1 << 20
    assert readers.spread_for([100 * mb] * 64, 8) is None
    assert readers.spread_for([4000 * mb, 10 * mb], 8) == 187
    assert readers.spread_for([mb], 8) is None


def test_spread_balances_equal_rows(spark):
    df = spark.range(0, 4000, 1, 1).select(F.lit("copy").alias("value"))
    sizes = [r["n"] for r in readers.spread(df, 8).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_inferred_and_variant(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":{"b":1},"c":[1.5]}\n{"a":{"b":2}}\n')
    df = readers.read_inferred(spark, str(tmp_path))
    assert df.schema.simpleString() == "struct<a:struct<b:bigint>,c:array<double>>"
    variant = readers.read_inferred(spark, str(tmp_path), as_variant=True)
    assert variant.select(F.sum(F.variant_get("record", "$.a.b", "int"))).first()[0] == 3


def test_shredded_files_with_different_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("1", "x")], "_id string, a string")
    b = spark.createDataFrame([("2", "y")], "b string, _id string")
    assert sinks.write_shredded(a, f"{path}/records_a_1") == {"rows": 1}
    b.select("_id", "b").write.parquet(f"{path}/records_b_1")
    df = readers.read_shredded(spark, f"{path}/*", merge_schema=True)
    assert sorted(tuple(r) for r in df.select("_id", "a", "b").collect()) in (
        [("1", "x", None), ("y", None, "2")], [("1", "x", None), ("2", None, "y")])
    assert sum(r["n_rows"] for r in readers.file_rows(spark, f"{path}/*").collect()) == 2


def test_merge_candidates(spark, tmp_path):
    for name in ("metadata_x_1", "journals_x_1", "digital_lending_x_2", "note"):
        (tmp_path / f"{name}.parquet").write_bytes(b"PAR1")
    names = {r["file_name"] for r in readers.merge_candidates(spark, str(tmp_path), "elasticsearchaux").collect()}
    assert names == {"metadata_x_1.parquet", "journals_x_1.parquet", "digital_lending_x_2.parquet"}
    assert readers.merge_candidates(spark, str(tmp_path), "aac").count() == 4


def test_id_lookup_reaches_parquet(spark, tmp_path):
    from quire.plans.search_index import id_lookup

    names = ("original_filename_best", "title_best", "author_best", "publisher_best", "year_best", "filesize_best",
             "extension_best", "cover_url_best", "unused")
    df = spark.range(100).select(F.md5(F.col("id").cast("string")).alias("_id"),
                                 *[F.lit("v").alias(f"_source_file_unified_data_{n}") for n in names])
    sinks.write_shredded(df, str(tmp_path / "t"))
    hit = id_lookup(readers.read_shredded(spark, str(tmp_path / "t")), "c4ca4238a0b923820dcc509a6f75849b")
    assert hit.count() == 1
    text = plan_of(hit)
    assert "EqualTo(_id,c4ca4238a0b923820dcc509a6f75849b)" in text and "unused" not in text


def test_selection_document_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("metadata", '{"a":{"b.c":1}}'), ("journals", '{"a":1}')], "dataset string, value string")
    profile = pt.profile(df).cache()
    selected = fl.select_fields(profile)
    path = str(tmp_path / "doc")
    sinks.write_document(fl.selection_document(profile, selected, "elasticsearchaux", "all"), path)
    got = [tuple(r) for r in sinks.read_document(spark, path, "metadata").select("path", "pointer").collect()]
    assert got == [("a", "/a"), ("a.b.c", "/a/b.c")]
    assert sinks.read_document(spark, path, "absent").count() == 0
    union = {r["path"]: r["datasets"] for r in sinks.read_combined(spark, path, "elasticsearchaux").collect()}
    assert union == {"a": ["journals", "metadata"], "a.b.c": ["metadata"]}
    stored = json.loads(spark.read.text(path, wholetext=True).first()[0])
    assert stored["record_counts"] == {"journals": 1, "metadata": 1}
    assert stored["field_presence_threshold"] == {"elasticsearch": 0.2, "aac": 0.2}
    assert stored["elasticsearchaux_common_fields"] == [{"field": "a"}]
