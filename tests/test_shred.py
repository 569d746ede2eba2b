"""Shredding quirks, one by one."""

import pytest
from pyspark.sql import functions as F

from quire.operators import shred as sh
from quire.operators.shred import Field
from tests.conftest import plan_of


def _parsed(spark, lines):
    df = spark.createDataFrame([(f"f{i % 2}", s) for i, s in enumerate(lines)], "file_path string, value string")
    return sh.parse_search_lines(df)


def test_envelope_and_bad_lines(spark):
    lines = ['{"_id":"1","_score":1.5,"_source":{"a" : 1},"x":9}\r', '{"_id":"2"} junk', "", "  ", "\r", "\t ", "bad", "[1]", "5",
             "null", '{"_id":"3"},{"_id":"4"}', '{"_id":"5","_id":"6"}', "{'_id':1}", '{"_id":{"k":1},"_score":"x"}']
    rows = _parsed(spark, lines).collect()
    good = [(r["_id"], r["_score"], r["_source"]) for r in rows if r[sh.CORRUPT] is None]
    assert good == [("1", 1.5, '{"a":1}'), ("6", None, None), ('{"k":1}', None, None)]
    bad = {r[sh.CORRUPT] for r in rows if r[sh.CORRUPT] is not None}
    assert bad == {'{"_id":"2"} junk', "bad", "[1]", "5", "null", '{"_id":"3"},{"_id":"4"}', "{'_id':1}"}


def test_rows_in_are_rows_out_plus_quarantined(spark):
    parsed = _parsed(spark, ['{"_id":"1"}', "bad", '{"_id":"2"}', '{"_id":"3"}'])
    for mode in ("row", "file"):
        assert sh.accepted(parsed, mode).count() + sh.quarantined(parsed, mode).count() == 4
    assert sh.quarantined(parsed, "file").count() == 2
    fields = [Field.of("_source.a")]
    assert sh.shred_search(parsed, fields).count() == 3
    assert sh.shred_search(parsed, fields, keep_corrupt=True).count() == 4


def test_values(spark):
    line = ('{"_id":"1","_source":{"a":{"b":[{"c":1.10},2],"B":"x","q\'s":"q"},"k.x":7,"k":{"x":"deep"},'
            '"e":"","n":null,"t":true,"m":[[[3]]],"u":"\\u00e9\\n"}}')
    fields = [
        Field.of("_source.a"), Field.of("_source.a.b"), Field.of("_source.a.b[0]"), Field.of("_source.a.b[0].c"),
        Field.of("_source.a.B", "upper"), Field.of("_source.a.q's", "quote"), Field("_source.k.x", "nested", "/_source/k/x"),
        Field("_source.k.x", "dotted", "/_source/k.x"), Field.of("_source.e"), Field.of("_source.n"),
        Field.of("_source.t"), Field.of("_source.m[0][0][0]"), Field.of("_source.u"), Field.of("_source.absent.deep"),
    ]
    row = sh.shred_search(_parsed(spark, [line]), fields).first().asDict()
    assert row == {
        "_index": None, "_id": "1", "_score": None, "_source_a": '{"b":[{"c":1.1},2],"B":"x","q\'s":"q"}',
        "_source_a_b": '[{"c":1.1},2]', "_source_a_b_0_": '{"c":1.1}', "_source_a_b_0__c": "1.1", "upper": "x",
        "quote": "q", "nested": "deep", "dotted": "7", "_source_e": "", "_source_n": None, "_source_t": "true",
        "_source_m_0__0__0_": "3", "_source_u": "é\n", "_source_absent_deep": None,
    }


def test_wrong_kinds_on_the_way_are_null(spark):
    lines = ['{"_source":{"a":"{\\"b\\":1}"}}', '{"_source":{"a":[{"b":1}]}}', '{"_source":{"a":5}}', '{"_source":"s"}']
    got = sh.shred_search(_parsed(spark, lines), [Field.of("_source.a"), Field.of("_source.a.b")])
    assert [r["_source_a"] for r in got.collect()] == ['{"b":1}', '[{"b":1}]', "5", None]


def test_one_pass_gives_the_same(spark):
    lines = ['{"_id":"1","_score":2,"_source":{"a":{"b":[1]},"A":"x","q\'s":{"y":null}}}', '{"_id":"2","_source":"s"}',
             '{"_id":"3","_source":[{"a":1}]}', '{"_id":"4","_source":null}', '{"_id":"5"}', "bad", "", "[{}]",
             '{"_id":"6","_source":{"a":"{}"}} x', '{"_id":"7","_source":{"a":1},"_source":{"A":2}}']
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    for paths in (["a", "a.b", "a.b[0]", "q's.y"], ["a.b"], []):
        fields = [Field.of(f"_source.{p}") for p in paths]
        if paths:
            fields.append(Field("_source.A", "upper", "/_source/A"))
        for keep in (False, True):
            two = sh.shred_search(sh.parse_search_lines(df), fields, keep_corrupt=keep)
            one = sh.shred_search(sh.parse_search_lines(df, fields=fields), fields, keep_corrupt=keep)
            assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    root_array = [Field.of("_source[0].a")]
    got = sh.shred_search(sh.parse_search_lines(df, fields=root_array), root_array)
    assert [r[3] for r in got.collect() if r["_id"] == "3"] == ["1"]


def test_only_paths_below_the_root_are_shredded(spark):
    fields = [Field.of("_source"), Field.of("_id"), Field.of("extra"), Field.of("other.a"), Field.of("_source.a")]
    assert sh.shred_search(_parsed(spark, ['{"_id":"1"}']), fields).columns == ["_index", "_id", "_score", "_source_a"]


def test_aac_keeps_metadata_text(spark):
    df = spark.createDataFrame([('{"aacid":"x","metadata":{"a":{"b":1}},"data_folder":"f"}',)], "value string")
    row = sh.shred_aac(sh.parse_aac_lines(df), [Field.of("metadata"), Field.of("metadata.a.b"), Field.of("aacid")]).first()
    assert row.asDict() == {"aacid": "x", "metadata": '{"a":{"b":1}}', "metadata_a_b": "1"}


@pytest.mark.parametrize("n", [1, 40, 300])
def test_each_level_is_parsed_once(spark, n):
    fields = [Field.of("_source.f"), *[Field.of(f"_source.f.k{i}") for i in range(n)], Field.of("_source.g.h")]
    df = sh.shred_search(_parsed(spark, ['{"_source":{"f":{"k0":"v"},"g":{"h":2}}}']), fields)
    assert df.first()["_source_f_k0"] == "v"
    # one parse for the line, one per inner node: _source, f, g
    text = plan_of(df)
    text = text if "Physical" not in text else text[text.index("Physical"):]
    assert text.count("from_json(") == 4


def test_matches_json_path_extraction(spark, duck):
    lines = ['{"_source":{"a":{"b":[{"c":[1,2]}],"d":"x"},"e":{"f":{"g":null,"h":[]}}}}', '{"_source":{"a":{"d":{"z":1}}}}']
    paths = ["a", "a.b", "a.b[0]", "a.b[0].c", "a.b[0].c[0]", "a.d", "e", "e.f", "e.f.g", "e.f.h", "e.f.h[0]"]
    got = sh.shred_search(_parsed(spark, lines), [Field.of(f"_source.{p}") for p in paths]).drop("_index", "_id", "_score")
    want = sorted((tuple(duck.execute("select ?::json ->> ?", [s, f"$._source.{p}"]).fetchone()[0] for p in paths)
                   for s in lines), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_keep_columns(spark):
    df = sh.shred_search(_parsed(spark, ['{"_id":"1"}']).withColumn("dataset", F.lit("d")), [], keep=["dataset"])
    assert df.columns == ["dataset", "_index", "_id", "_score"]
