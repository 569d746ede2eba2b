"""Column helpers against DuckDB, which decides what the text casts and rounding must give."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import values as V

NUMBERS = [
    "1999", " 1999 ", "1999.7", "2000.5", "2001.5", "-2.5", "1e3", "1E3", "1_000", "", "+5", "-5", ".5", "5.", "abc",
    "2147483647", "2147483648", "2147483647.4", "1__0", "1.5e1", "1e-1", "1 9", "\t7\n", "5f", "5d", "-0", "00012",
    "1_0.5", "--5", "c1999", "12-13", "1e400", None,
]


def test_try_int_agrees_with_duckdb(spark, duck):
    df = spark.createDataFrame([(s,) for s in NUMBERS], "s string")
    got = [r[0] for r in df.select(V.try_int("s")).collect()]
    want = [duck.execute("select try_cast(? as integer)", [s]).fetchone()[0] for s in NUMBERS]
    assert got == want


def test_try_float_agrees_with_duckdb(spark, duck):
    texts = [*NUMBERS, "inf", "-Infinity", "0x10", "3145728", "n/a"]
    df = spark.createDataFrame([(s,) for s in texts], "s string")
    got = [r[0] for r in df.select(V.try_float("s")).collect()]
    want = [duck.execute("select try_cast(? as float)", [s]).fetchone()[0] for s in texts]
    assert got == want


def test_round2_agrees_with_duckdb(spark, duck):
    random.seed(7)
    xs = [1.005, 0.125, -0.125, 2.675, 1e15, 0.0, -1.005, *[random.uniform(-1e4, 1e4) for _ in range(3000)],
          *[random.randint(-99999, 99999) / 200 for _ in range(2000)]]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(V.round2("x")).collect()]
    duck.execute("create or replace table t as select unnest(?::double[]) as x", [xs])
    want = [r[0] for r in duck.execute("select round(x, 2) from t").fetchall()]
    assert got == want


def test_size_mb_is_exact(spark, duck):
    sizes = [str(n) for n in (3145728, 1, 1023, 987654321, 16777217)]
    df = spark.createDataFrame([(s,) for s in sizes], "s string")
    got = [r[0] for r in df.select(V.size_mb("s")).collect()]
    want = [duck.execute("select try_cast(? as float) / (1024*1024)", [s]).fetchone()[0] for s in sizes]
    assert got == want


@pytest.mark.parametrize(
    ("held", "label"),
    [
        (None, "Not Rare"), ("null", "Not Rare"), ('"x"', "Not Rare"), ("[]", "Not Rare"), ('["many"]', "Not Rare"),
        ('["1","many"]', "Not Rare"), ('["3"]', "Rare"), ('[["many"]]', "Not Rare"), ('[{"k":"many"}]', "Not Rare"),
        ('[{"many":1}]', "Rare"), ('["not many"]', "Rare"), ('["a,\\"many\\",b"]', "Rare"), ("[null]", "Rare"),
        ('[ "many" ]', "Not Rare"), ('["\\u006dany"]', "Not Rare"), ('{"a":1}', "Not Rare"),
    ],
)
def test_rarity(spark, duck, held, label):
    doc = "{}" if held is None else '{"h":%s}' % held
    df = spark.createDataFrame([(doc,)], "d string").select(F.get_json_object("d", "$.h").alias("h"))
    assert df.select(V.rarity(F.col("h"))).first()[0] == label
    sql = """select case when h is not null and json_array_length(h) > 0 and not json_contains(h, '"many"')
      then 'Rare' else 'Not Rare' end from (select json_extract(?::json, '$.h') as h)"""
    assert duck.execute(sql, [doc]).fetchone()[0] == label


def test_languages(spark):
    rows = ["en", '["fr","en"]', "[fr]", "[", "[]"]
    df = spark.createDataFrame([(s,) for s in rows], "s string")
    assert [r[0] for r in df.select(V.first_language("s")).collect()] == ["en", "fr", "", "[", ""]


def test_cover_source_takes_the_first_host(spark):
    urls = ["http://x.archive.org/openlibrary.org", "https://OPENLIBRARY.ORG", "http://isbndb.com/1", "x"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(V.cover_source("u")).collect()] == ["Internet Archive", "Other", "ISBNdb", "Other"]
    one = df.select(V.cover_source("u", {"OPEN": "o"}, "rest")).collect()
    assert [r[0] for r in one] == ["rest", "o", "rest", "rest"]


def test_json_strings(spark):
    rows = ['["a","b"]', "[]", "[null]", '[1,{"k":2}]', "plain", None]
    df = spark.createDataFrame([(s,) for s in rows], "s string")
    got = [r[0] for r in df.select(V.json_strings("s", strict=False)).collect()]
    assert got == [["a", "b"], [], [None], ["1", '{"k":2}'], None, None]
    bad = ["[a, b]", '["a"', '"x"', '{"a":1}', '["a"] junk', "plain"]
    wrong = spark.createDataFrame([(s,) for s in [*bad, "[]", None]], "s string")
    assert [r[0] for r in wrong.select(V.unreadable_list("s")).collect()] == [True] * 6 + [False] * 2
    with pytest.raises(Exception, match="not a JSON array"):
        wrong.select(V.json_strings("s")).collect()
