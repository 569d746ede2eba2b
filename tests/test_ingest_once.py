"""What an ingest reads, loses and remembers."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from quire.operators import fields as fl
from quire.operators import shred as sh
from quire.plans.ingest import IngestOptions, ingest_group
from quire.sources import sinks
from quire.sources.files import exists
from quire.sources.landing import dataset_of, list_files
from quire.sources.readers import read_shredded


def record(i, **more):
    return {"_index": "i", "_id": f"md5:{i}", "_score": i, "_source": {"file": {"title": f"t{i}", "size": str(i), **more}}}


def put(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n"
    (folder / name).write_bytes(gzip.compress(text.encode()))


def listing(spark, folder):
    return list_files(spark, str(folder)).withColumn("dataset", dataset_of("file_name"))


def run(spark, folder, target, group="elasticsearch", options=None, **more):
    return ingest_group(spark, listing(spark, folder), str(target), group, options or IngestOptions(sample_rate=1.0), **more)


def records_read(spark):
    """Rows that all tasks so far read from files."""
    gateway = spark.sparkContext._gateway
    none = gateway.jvm.java.util.ArrayList()
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    return sum(stages.apply(k).inputRecords() for k in range(stages.size()))


def lines_read(spark, folder, target, lines, options):
    """Rows read by the jobs of one ingest; small tables of its own included."""
    put(folder, "aarecords__0.json.gz", lines)
    put(folder, "aarecords__1.json.gz", [record(i) for i in range(5000, 6000)])
    before = records_read(spark)
    result = run(spark, folder, target, options=options)
    return records_read(spark) - before, result.counts["records"]


@pytest.mark.parametrize("mode", ["row", "file"])
def test_a_bad_line_costs_no_second_read(spark, tmp_path, mode):
    good = [record(i) for i in range(2000)]
    o = IngestOptions(sample_rate=1.0, quarantine=mode)
    clean, counts = lines_read(spark, tmp_path / "a", tmp_path / "out_a", good, o)
    assert counts["rows"] == 3000 and counts["quarantined"] == 0
    spoiled, counts = lines_read(spark, tmp_path / "b", tmp_path / "out_b", ["broken", *good], o)
    bad = read_shredded(spark, str(tmp_path / "out_b/_quarantine/records"))
    if mode == "row":
        assert counts["rows"] == 3000 and [r["line"] for r in bad.collect()] == ["broken"]
        assert bad.first()["file_path"].endswith("aarecords__0.json.gz")
        assert spoiled - clean < 200  # the line itself, and a few rows of reports
    else:  # the texts of the file that is set aside are read again, those of the other are not
        assert counts["rows"] == 1000 and counts["quarantined"] == bad.count() == 2001
        assert spoiled - clean < 2001 + 200
    table = read_shredded(spark, str(tmp_path / "out_b/records"))
    assert table.columns == read_shredded(spark, str(tmp_path / "out_a/records")).columns
    assert not {"__bad", "__file", "file_path"} & set(table.columns) and not exists(spark, f"{tmp_path}/out_b/_staged/records")


def test_only_bad_lines(spark, tmp_path):
    """A table without good rows is there, empty; nothing of it is known, so it has no selected field."""
    put(tmp_path / "in", "aarecords__0.json.gz", ["x", "{", ""])
    got = run(spark, tmp_path / "in", tmp_path / "out")
    assert got.counts["records"] == {"rows": 0, "quarantined": 2, "fields": 0} and list(got.inferred) == ["records"]
    put(tmp_path / "in2", "aarecords__0.json.gz", [record(1)])
    first = run(spark, tmp_path / "in2", tmp_path / "out2")
    again = run(spark, tmp_path / "in", tmp_path / "out3", selection=first.selection_path)
    table = read_shredded(spark, again.tables["records"])
    assert again.counts["records"]["quarantined"] == 2 and table.count() == 0
    assert table.columns == read_shredded(spark, first.tables["records"]).columns


def test_defects_are_counted_and_rows_kept(spark, tmp_path):
    lines = [record(i) for i in range(40)]
    lines[3]["_score"] = "abc"
    lines[4]["_score"] = "4.5"
    lines[5]["_score"] = {"x": 1}
    lines[6]["_source"] = "text"
    lines[7]["_source"] = [1]
    lines[8]["_source"] = None
    lines[9] = '{"_id":"first",' + json.dumps(lines[9])[1:]
    lines[10] = '{"_score":"x","_id":"first",' + json.dumps({**lines[10], "_score": "5f"})[1:]
    put(tmp_path / "in", "aarecords__0.json.gz", [*lines, "broken"])
    got = run(spark, tmp_path / "in", tmp_path / "out")
    assert got.defects == {"records": {"lost_score": 3, "body_no_object": 2, "repeated_key": 2}}
    assert got.counts["records"]["rows"] == 40 and got.counts["records"]["quarantined"] == 1
    table = {r["_id"]: r["_score"] for r in read_shredded(spark, got.tables["records"]).collect()}
    assert table["md5:4"] == 4.5 and table["md5:3"] is None and table["md5:9"] == 9.0 and table["md5:10"] is None
    stored = {(r["dataset"], r["defect"]): r["n_records"] for r in spark.read.parquet(f"{tmp_path}/out/_reports/defects").collect()}
    assert stored[("records", "body_no_object")] == 2
    # both forms of the parse see the same, apart from texts that look like objects
    text = spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string")
    for fields in (None, [sh.Field.of("_source.file.title")]):
        bits = sh.parse_search_lines(text, fields=fields, ledger=True).agg(
            *[F.count_if(sh.has_defect(n)).alias(n) for n in sh.DEFECT_BITS]).first().asDict()
        assert bits == got.defects["records"]
    aac = spark.createDataFrame([('{"aacid":"a","metadata":"m"}',), ('{"aacid":"a","aacid":"b","metadata":{}}',), ("x",)], "value string")
    assert [r["_defects"] for r in sh.parse_aac_lines(aac, ledger=True).collect()] == [2, 4, 0]


def test_a_stored_selection_needs_no_profile(spark, tmp_path):
    put(tmp_path / "in", "aarecords_metadata__0.json.gz", [record(i) for i in range(20)])
    put(tmp_path / "in", "aarecords_journals__0.json.gz", [record(i, issn="1") for i in range(20)])
    first = run(spark, tmp_path / "in", tmp_path / "out", "elasticsearchaux")
    before = records_read(spark)
    put(tmp_path / "in2", "aarecords_metadata__0.json.gz", [record(i, new="n") for i in range(3000)])
    put(tmp_path / "in2", "aarecords_other.json.gz", [{"a": 1, "b": "x"}, {"a": 2}])
    again = run(spark, tmp_path / "in2", tmp_path / "out2", "elasticsearchaux", selection=first.selection_path)
    assert records_read(spark) - before < 3000 + 200  # one look at the lines
    assert again.profile_path is None and not exists(spark, f"{tmp_path}/out2/_reports/profile")
    tables = [read_shredded(spark, t) for t in (first.tables["metadata"], again.tables["metadata"])]
    assert tables[0].columns == tables[1].columns and "_source_file_issn" in tables[1].columns
    assert tables[1].count() == 3000
    assert [tuple(r) for r in read_shredded(spark, again.inferred["other"]).orderBy("a").collect()] == [(1, "x"), (2, None)]


def test_names_hold_from_run_to_run(spark, tmp_path):
    def lines(*more):
        return [{"_id": f"{i}", "_source": {"a_b": {"c": "old"}, "x": {"2": "p"}, **{k: v for m in more for k, v in m.items()}}}
                for i in range(10)]

    put(tmp_path / "in1", "aarecords__0.json.gz", lines({"a": {"B_C": "other"}}))
    first = run(spark, tmp_path / "in1", tmp_path / "out1")
    one = {r["path"]: r["column"] for r in sinks.read_selection(spark, first.selection_path).collect()}
    assert one["_source.a.B_C"] == "_source_a_B_C" and one["_source.a_b.c"] == "_source_a_b_c__2"
    # a path that sorts before both comes, one of the two is gone
    put(tmp_path / "in2", "aarecords__0.json.gz", lines({"a": {"b": {"c": "new"}}, "A": {"b": {"C": "newer"}}}))
    second = run(spark, tmp_path / "in2", tmp_path / "out2", names=first.selection_path)
    two = {r["path"]: r["column"] for r in sinks.read_selection(spark, second.selection_path).collect()}
    assert all(two[p] == c for p, c in one.items() if p in two) and "_source.a.B_C" not in two
    assert two["_source.A.b.C"] == "_source_A_b_C__3" and two["_source.a.b.c"] == "_source_a_b_c__4"
    row = read_shredded(spark, second.tables["records"]).first()
    assert row["_source_a_b_c__2"] == "old" and row["_source_a_b_c__4"] == "new"
    # the name of the path that was gone is still known to a third run
    third = run(spark, tmp_path / "in1", tmp_path / "out3", names=second.selection_path)
    three = {r["path"]: r["column"] for r in sinks.read_selection(spark, third.selection_path).collect()}
    assert three["_source.a.B_C"] == "_source_a_B_C" and three["_source.a_b.c"] == "_source_a_b_c__2"


def test_combined_names_hold_too(spark):
    selected = spark.createDataFrame(
        [("metadata", "s.a_b", "s_a_b", "/s/a_b"), ("journals", "s.a.b", "s_a_b", "/s/a/b")],
        "dataset string, path string, column string, pointer string")
    known = fl.column_registry(selected.filter("dataset = 'metadata'"), "elasticsearchaux")
    names = {r["path"]: r["column"] for r in fl.combined_fields(selected, "elasticsearchaux", known).collect()}
    assert names == {"s.a_b": "s_a_b", "s.a.b": "s_a_b__2"}  # by path alone it would be the other way round
    assert {r["path"]: r["column"] for r in fl.combined_fields(selected, "elasticsearchaux").collect()}["s.a.b"] == "s_a_b"


def test_types_of_unknown_records(spark, tmp_path):
    lines = [{"id": 1, "n": 2, "x": {"a": 1.5, "b c": "t", "d.e": None}, "tags": ["x"], "y": None, "o": {}},
             {"id": 3_000_000_000_000, "n": "s", "x": {"a": 2, "q": {"A": 1, "a": 2}}, "z": True, "Z": "big", "it's": 5,
              "a, b: c": [{"k": 1}]}]
    put(tmp_path / "in", "unknown.json.gz", [*lines, "broken"])
    got = run(spark, tmp_path / "in", tmp_path / "out")
    assert got.tables == {} and got.counts["other"]["quarantined"] == 1
    rows = [r.asDict(True) for r in read_shredded(spark, got.inferred["other"]).orderBy("id").collect()]
    assert rows[0]["x"] == {"a": 1.5, "b c": "t", "d.e": None, "q": None} and rows[0]["n"] == "2" and rows[0]["o"] == "{}"
    assert rows[1]["a, b: c"] == [{"k": 1}] and rows[1]["it's"] == 5 and (rows[1]["Z"], rows[1]["z__2"]) == ("big", True)
    assert json.loads(rows[1]["x"]["q"]) == {"A": 1, "a": 2}
    put(tmp_path / "in2", "unknown.json.gz", ["[1]", '{"a": 1}', "3"])
    got = run(spark, tmp_path / "in2", tmp_path / "out2")
    assert sorted(r["record"] for r in read_shredded(spark, got.inferred["other"]).collect()) == ["3", "[1]", '{"a":1}']
