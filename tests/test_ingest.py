"""The whole way on a small landing area."""

import gzip
import json

import pytest
import zstandard
from pyspark.sql import functions as F

from quire.plans.ingest import IngestOptions, ingest, ingest_group
from quire.plans.search_index import column_listing, file_sizes, rare_books
from quire.sources.landing import list_files
from quire.sources.readers import read_shredded


def _record(i, kind):
    unified = {"title_best": f"t{i}", "filesize_best": str(1048576 * i), "content_type_best": "book_fiction",
               "classifications_unified": {"oclc_holdings": ["many"] if i % 2 else ["3"]}}
    if kind == "journals":
        unified["issn"] = ["1234"]
    if i == 0:
        unified["seldom"] = 1
    return json.dumps({"_index": "i", "_id": f"md5:{i}", "_score": 1, "_source": {"file_unified_data": unified}})


@pytest.fixture()
def area(tmp_path):
    def put(path, lines, pack):
        target = tmp_path / "torrent" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(pack("\n".join(lines).encode() + b"\n"))

    main = [_record(i, "records") for i in range(20)]
    put("aa1/elasticsearch/aarecords__0.json.gz", [*main, "broken", ""], gzip.compress)
    put("aa1/elasticsearch/aarecords__1.json.gz", [_record(i, "records") for i in range(20, 30)], gzip.compress)
    put("aa1/elasticsearchaux/aarecords_metadata__0.json.gz", [_record(i, "metadata") for i in range(9)], gzip.compress)
    put("aa1/elasticsearchaux/aarecords_journals__0.json.gz", [_record(i, "journals") for i in range(9)], gzip.compress)
    aac = [json.dumps({"aacid": f"aacid__c__{i}", "metadata": {"t": i, "a": [{"b": i}]}}) for i in range(6)]
    put("aa1/aac/x_meta__aacid__coll__1.jsonl.seekable.zst", aac, zstandard.ZstdCompressor().compress)
    return tmp_path


def test_rows_columns_and_reports(spark, area):
    got = ingest(spark, str(area / "torrent"), str(area / "out"), IngestOptions(min_file_bytes=1, sample_rate=1.0))
    main = got["elasticsearch"]
    assert main.counts == {"records": {"rows": 30, "quarantined": 1, "fields": 10}}
    table = read_shredded(spark, main.tables["records"])
    assert table.count() == 30 and "_source_file_unified_data_seldom" not in table.columns
    assert {r["rarity"]: r["count"] for r in rare_books(table).collect()} == {"Not Rare": 15, "Rare": 15}
    assert file_sizes(table, min_count=0).first()["max_size_mb"] == 29.0
    bad = spark.read.parquet(str(area / "out/elasticsearch/_quarantine/records"))
    assert [r["line"] for r in bad.collect()] == ["broken"] and bad.columns == ["file_path", "line"]
    # auxiliary datasets share one schema, also for a field only one of them has
    aux = {d: read_shredded(spark, p) for d, p in got["elasticsearchaux"].tables.items()}
    assert aux["metadata"].columns == aux["journals"].columns
    assert aux["journals"].select("_source_file_unified_data_issn").first()[0] == '["1234"]'
    assert aux["metadata"].select("_source_file_unified_data_issn").first()[0] is None
    aac = read_shredded(spark, got["aac"].tables["aac_coll"])
    assert aac.columns == ["aacid", "metadata", "metadata_a", "metadata_a_0__b", "metadata_t"]
    assert spark.read.parquet(f"{area}/out/elasticsearch/_reports/profile").filter("path = '_id'").first()["n_records"] == 30
    text = spark.read.text(f"{area}/out/elasticsearch/_reports/text/dataset=records").collect()
    assert text[0]["value"] == "selected\t1\t100.00\t30\t30\t_id\t_id" and len(text) == 2 * 10 + 1
    assert text[-1]["value"] == "all\t11\t3.33\t1\t30\t_source.file_unified_data.seldom\t"
    listing = column_listing(aac).collect()
    assert [r["column"] for r in listing] == aac.columns and {r["type"] for r in listing} == {"string"}


def test_file_quarantine_and_file_sample(spark, area):
    o = IngestOptions(min_file_bytes=1, sample_unit="file", quarantine="file")
    got = ingest(spark, str(area / "torrent"), str(area / "out"), o)
    counts = got["elasticsearch"].counts["records"]
    assert (counts["rows"], counts["quarantined"]) == (10, 21) and counts["fields"] > 5
    bad = spark.read.parquet(str(area / "out/elasticsearch/_quarantine/records"))
    assert sorted(r["line"] for r in bad.collect()) == sorted([*[_record(i, "records") for i in range(20)], "broken"])


def test_bad_lines_as_null_rows(spark, area):
    o = IngestOptions(min_file_bytes=1, sample_rate=1.0, keep_corrupt=True)
    got = ingest(spark, str(area / "torrent"), str(area / "out"), o)
    counts = got["elasticsearch"].counts["records"]
    assert (counts["rows"], counts["quarantined"]) == (31, 0)


def test_a_written_table_is_never_overwritten(spark, area):
    o = IngestOptions(min_file_bytes=1, sample_rate=1.0)
    ingest(spark, str(area / "torrent"), str(area / "out"), o)
    with pytest.raises(Exception, match="already exists"):
        ingest(spark, str(area / "torrent"), str(area / "out"), o)


def test_files_are_sampled_when_asked(spark, tmp_path):
    folder = tmp_path / "torrent/aa1/elasticsearch"
    folder.mkdir(parents=True)
    for n in range(20):
        (folder / f"aarecords__{n}.json.gz").write_bytes(gzip.compress((_record(n, "records") + "\n").encode()))
    (folder.parent / "elasticsearchaux").mkdir()
    lines = "\n".join(_record(n, "metadata") for n in range(5)).encode()
    (folder.parent / "elasticsearchaux/aarecords_metadata__0.json.gz").write_bytes(gzip.compress(lines))
    o = IngestOptions(min_file_bytes=1, sample_rate=0.5, sample_unit="file")
    got = ingest(spark, str(tmp_path / "torrent"), str(tmp_path / "out"), o)
    row = spark.read.parquet(got["elasticsearch"].profile_path).filter("path = '_id'").first()
    assert row["sampled_n"] == 10 and abs(row["n_records"] - 20) <= 1
    assert got["elasticsearch"].counts["records"]["rows"] == 20
    assert got["elasticsearchaux"].counts["metadata"]["rows"] == 5
    assert len(list((tmp_path / "out/elasticsearch/records").glob("*.parquet"))) == 1  # merged


def test_a_small_dataset_keeps_its_fields_whatever_the_sample(spark, tmp_path):
    for seed in range(4):
        folder = tmp_path / f"torrent{seed}/aa1/elasticsearchaux"
        folder.mkdir(parents=True)
        for name in ("metadata", "journals"):
            lines = "\n".join(_record(n, name) for n in range(3)).encode()
            (folder / f"aarecords_{name}__0.json.gz").write_bytes(gzip.compress(lines))
        o = IngestOptions(min_file_bytes=1, seed=seed)
        got = ingest(spark, str(tmp_path / f"torrent{seed}"), str(tmp_path / f"out{seed}"), o)["elasticsearchaux"]
        for name in ("metadata", "journals"):
            assert got.counts[name]["rows"] == 3 and got.counts[name]["fields"] > 5


def test_merged_files_hold_bounded_lines(spark, tmp_path):
    lines = spark.range(0, 400, 1, 8).select(F.concat(
        F.lit('{"_index":"i","_id":"'), F.col("id").cast("string"), F.lit('","_score":1,"_source":{"a":"'),
        F.repeat(F.lit("x"), 1000), F.lit('"}}')).alias("value"))  # about 1 KB each, of little size when compressed
    lines.write.option("compression", "gzip").text(str(tmp_path / "in"))
    files = list_files(spark, str(tmp_path / "in"), "*.gz").withColumn("dataset", F.lit("records"))
    for name, bound, wanted in (("one", 1 << 30, 1), ("many", 110_000, 4)):
        o = IngestOptions(sample_rate=1.0, merged_line_bytes=bound)
        result = ingest_group(spark, files, str(tmp_path / name), "elasticsearch", o)
        table = result.tables["records"]
        assert list_files(spark, table, "*.parquet").count() == wanted and result.counts["records"]["rows"] == 400
