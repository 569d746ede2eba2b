"""Report shapes that a single check does not reach."""

import math
import random

from pyspark.sql import functions as F

from quire.functions.columns import unified
from quire.operators import fields as fl
from quire.operators import summaries as sm
from quire.plans import collection as c
from quire.plans import search_index as q
from quire.sources import sinks
from tests.conftest import plan_of


def test_quantiles_against_sorting(spark):
    random.seed(3)
    # a third of the rows hold one value, the rest are spread unevenly
    xs = [7.0] * 200 + [random.expovariate(0.1) for _ in range(390)] + [None] * 11
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    known = sorted(x for x in xs if x is not None)
    shares = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]
    want = {s: known[max(1, math.ceil(s * len(known))) - 1] for s in shares}
    for exact_rows in (1, 2, 64, 10_000):
        assert {r["share"]: r["v"] for r in sm.quantiles(df, "v", shares, exact_rows).collect()} == want
    assert sm.quantiles(df.limit(0), "v", shares).count() == 0


def test_quantiles_of_many_rows_narrow_by_passes(spark):
    df = spark.range(400_000).select((F.col("id") * 7919 % 400_009).cast("float").alias("v"))
    known = sorted(i * 7919 % 400_009 for i in range(400_000))
    shares = [0.001, 0.5, 0.9999]
    got = {r["share"]: r["v"] for r in sm.quantiles(df, "v", shares, exact_rows=500).collect()}
    assert got == {s: known[math.ceil(s * len(known)) - 1] for s in shares}


def test_a_bracket_without_its_rank_is_taken_back(spark, monkeypatch):
    monkeypatch.setattr(sm, "_SLACK", 1e-4)  # next to nothing, and a sketch of a few values
    monkeypatch.setattr(sm, "_SKETCH", 8)
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    got = {r["share"]: r["v"] for r in sm.quantiles(df, "v", [0.1, 0.5], exact_rows=100).collect()}
    assert got == {0.1: 99.0, 0.5: 499.0}


def test_approximate_quantiles_are_close(spark):
    df = spark.range(1, 2001).select((F.col("id") * 1048576).cast("string").alias(unified("filesize_best")))
    got = {r["share"]: r["size_mb"] for r in c.size_quantiles(df, exact=False).collect()}
    assert all(abs(v - 2000 * s) <= 2 for s, v in got.items()) and len(got) == 5


def test_shares_sum_to_a_hundred(spark):
    df = spark.range(997).select((F.col("id") % 13).cast("string").alias(unified("content_type_best")))
    rows = c.content_types(df).collect()
    assert abs(sum(r["percentage"] for r in rows) - 100) < 0.005 * len(rows) + 1e-9


def test_parameters_change_the_cut(spark):
    df = spark.range(100).select(F.lit("2").alias(unified("filesize_best")),
                                 F.when(F.col("id") < 10, "few").otherwise("many").alias(unified("content_type_best")))
    assert q.file_sizes(df).count() == 0
    assert [r["content_type"] for r in q.file_sizes(df, min_count=10).collect()] == ["many"]
    assert q.file_sizes(df, min_count=9).count() == 2


def test_hot_edition_is_whole(spark):
    """One main edition with most rows keeps all of its variations."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "1st").otherwise("2nd").alias(unified("edition_varia_best")),
        F.concat(F.lit('["v'), F.col("id").cast("string"), F.lit('","v0",null]')).alias(unified("edition_varia_additional")),
    )
    got = {r["main_edition"]: r for r in q.edition_variations(df, as_rows=False).collect()}
    assert got["1st"]["edition_variations"] == 2000 and len(got["1st"]["variations"]) == 2000
    assert got["2nd"]["edition_variations"] == 1001
    assert q.edition_variations(df, as_rows=True).count() == 3001
    assert q.edition_variations(df, limit=5000).count() == 3001


def test_text_that_is_no_number_fails_where_a_number_is_promised(spark):
    import pytest

    df = spark.createDataFrame([("x", "k")], ["_source_search_only_fields_search_score_base_rank", unified("content_type_best")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        q.rank_scores(df, 0).collect()


def test_author_is_a_literal(spark):
    names = ("title_best", "publisher_best", "year_best", "cover_url_best")
    df = spark.createDataFrame([("O'Neil' OR '1'='1",), ("b",)], [unified("author_best")])
    df = df.select("*", *[F.lit("1999").alias(unified(n)) for n in names])
    assert q.books_by_author(df, "O'Neil' OR '1'='1").count() == 1


def test_rarity_uses_the_narrowest_column(spark):
    df = spark.createDataFrame([('["3"]', "ignored", "ignored")], [
        unified("classifications_unified_oclc_holdings"), unified("classifications_unified"), "_source_file_unified_data"])
    assert [tuple(r) for r in q.rare_books(df).collect()] == [("Rare", 1)]


def test_one_record(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "_id string, n int")
    assert [tuple(r) for r in q.one_record(df).collect()] == [("a", 2)]
    assert q.one_record(df.drop("_id"), stable=False).count() == 1


def test_column_names_never_meet(spark):
    from quire.operators import fields as fl

    paths = ["x.y", "x_y", "x_y__2", "X.y", "x_y__2__1", "x.y__2"]
    named = fl.with_column_names(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert len({r["column"].lower() for r in named}) == len(paths)


def test_a_combined_field_is_read_by_each_datasets_own_pointer(spark):
    from quire.operators import fields as fl

    rows = [("metadata", "_source.a.b", "c", "/_source/a.b"), ("journals", "_source.a.b", "c", "/_source/a/b")]
    selected = spark.createDataFrame(rows, "dataset string, path string, column string, pointer string")
    got = {r["dataset"]: r["pointer"] for r in fl.fields_per_dataset(selected, "elasticsearchaux").collect()}
    assert got == {"metadata": "/_source/a.b", "journals": "/_source/a/b", "digital_lending": "/_source/a/b"}


def test_a_report_of_very_many_paths_is_numbered_in_blocks(spark, tmp_path):
    n = 1_000_000  # one dataset whose records use ids as keys
    profile = spark.range(n).select(
        F.lit("d").alias("dataset"), F.concat(F.lit("k."), F.lpad(F.col("id").cast("string"), 7, "0")).alias("path"),
        F.lit("/k/x").alias("pointer"), (F.col("id") % 100 + 1).alias("n_records"), F.lit(100).cast("long").alias("total_records"),
        (F.col("id") % 100 + 1).alias("sampled_n"), F.lit(100).cast("long").alias("sampled_total"))
    selected = fl.select_fields(profile.filter("n_records > 99"), threshold=0.99)
    report = fl.field_report(profile, selected, block_rows=100_000)
    assert "__block" in plan_of(report) and "hashpartitioning(dataset#" in plan_of(report)
    got = report.filter("section = 'all'").agg(F.count_distinct("position").alias("n"), F.max("position").alias("last")).first()
    assert tuple(got) == (n, n)
    # place: all paths of higher counts, then those of the same count with smaller ids
    wrong = report.filter("section = 'all'").withColumn("id", F.substring("path", 3, 7).cast("long")).filter(
        F.col("position") != (100 - F.col("n_records")) * (n // 100) + F.expr("id div 100") + 1)
    assert wrong.count() == 0
    assert report.filter("section = 'selected'").count() == n // 100


def test_report_files_read_in_order(spark, tmp_path):
    rows = [("b", "all", i, f"p{i}", None, 1.5, 1, 2) for i in range(1, 300)] + [("a", "selected", 1, "q\tr", "c", 50.0, 1, 2)]
    schema = "dataset string, section string, position int, path string, column string, presence_pct double, n_records long, total_records long"
    sinks.write_text_report(spark.createDataFrame(rows, schema).orderBy(F.rand(1)), str(tmp_path / "t"))
    lines = "".join(f.read_text() for f in sorted((tmp_path / "t/dataset=b").glob("part-*"))).splitlines()
    assert [line.split("\t")[1] for line in lines] == [str(i) for i in range(1, 300)]
    assert spark.read.text(str(tmp_path / "t/dataset=a")).first()[0] == "selected\t1\t50.00\t1\t2\tq r\tc"
