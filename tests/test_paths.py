"""Profiling against hand-written lines and a brute-force walk in Python."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators import fields as fl
from quire.operators import paths as pt

LINES = [
    '{"a":{"n":null,"o":{}}}',
    '{"a":[{"c":5},{"d":6}]}',
    '{"l":[[{"z":1}]]}',
    '{"l":[1]}',
    '{"l":[]}',
    '[{"t":1}]',
    "5",
    "not json",
    "",
    "   ",
    '{"a":1} trailing',
    '{"a":1},{"b":2}',
    '{"s":"{\\"q\\":1}"}',
]


def _profile(spark, lines, dataset="d", **kw):
    df = spark.createDataFrame([(dataset, s) for s in lines], "dataset string, value string")
    return pt.profile(df, **kw)


def test_edge_lines(spark):
    rows = _profile(spark, LINES).collect()
    got = {r["path"]: r["n_records"] for r in rows}
    assert got == {"a": 2, "a.n": 1, "a.o": 1, "a[0].c": 1, "l": 3, "l[0][0].z": 1, "[0].t": 1, "s": 1}
    assert {(r["total_records"], r["n_unparsed"]) for r in rows} == {(8, 3)}


def test_depth_is_never_cut(spark):
    for depth in (3, 8, 9, 10, 30):
        line = '{"k":' * depth + '[[{"w":{"{x":"[{"}}]]' + "}" * depth
        rows = _profile(spark, [line]).collect()
        keys = [".".join(["k"] * n) for n in range(1, depth + 1)]
        tail = keys[-1] + "[0][0].w"
        assert {r["path"] for r in rows} == {*keys, tail, tail + ".{x"}


def test_keys_with_separators_stay_apart(spark):
    rows = _profile(spark, ['{"x.y":1}', '{"x":{"y":2}}', '{"p/q~r":{"":2},"~i":1,"[0]":3}']).collect()
    got = sorted((r["path"], r["pointer"], r["n_records"]) for r in rows)
    assert got == sorted([
        ("x", "/x", 1), ("x.y", "/x.y", 1), ("x.y", "/x/y", 1), ("p/q~r", "/p~1q~0r", 1), ("p/q~r.", "/p~1q~0r/", 1),
        ("~i", "/~0i", 1), ("[0]", "/[0]", 1),
    ])
    selected = {r["path"]: r["pointer"] for r in fl.select_fields(_profile(spark, ['{"x.y":1,"x":{"y":2}}'])).collect()}
    assert selected["x.y"] == "/x/y"


def test_repeated_keys(spark):
    line = ['{"a":1,"a":{"b":2}}']
    assert [r["n_unparsed"] for r in pt.record_totals(
        pt.count_paths(spark.createDataFrame([("d", line[0])], "dataset string, value string"))).collect()] == [1]
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        assert {r["path"] for r in _profile(spark, line).collect()} == {"a", "a.b"}
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")


_KEYS = st.text("ab.[/~", min_size=1, max_size=3)
_JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text("{[x", max_size=3),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(_KEYS, inner, max_size=3),
    max_leaves=12,
)


def _walk(value, steps, found):
    """Every key below a value, as a tuple of steps, opening first elements only."""
    if isinstance(value, dict):
        for k, v in value.items():
            found.add((*steps, k))
            _walk(v, (*steps, k), found)
    elif isinstance(value, list) and value:
        _walk(value[0], (*steps, 0), found)
    return found


def _pointer(steps):
    return "".join("/" + ("~i" if s == 0 else s.replace("~", "~0").replace("/", "~1")) for s in steps)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_JSON, min_size=1, max_size=20))
def test_against_brute_force(spark, values):
    df = spark.createDataFrame([("d", json.dumps(v)) for v in values], "dataset string, value string")
    got = {r["pointer"]: r["n"] for r in pt.count_paths(df, levels=2).collect()}
    want = {"": len(values)}
    for v in values:
        for steps in _walk(v, (), set()):
            want[_pointer(steps)] = want.get(_pointer(steps), 0) + 1
    assert got == want


def test_selection_properties(spark):
    lines = [json.dumps({"a": {"b": i, **({"c": 1} if i % 5 == 0 else {})}, **({"d": 1} if i % 2 else {})})
             for i in range(50)]
    profile = _profile(spark, lines).cache()
    rows = {r["path"]: r["n_records"] / r["total_records"] for r in profile.collect()}
    assert all(0 < p <= 1 for p in rows.values()) and rows["a"] >= rows["a.b"] >= rows["a.c"]
    sizes = [fl.select_fields(profile, threshold=t).count() for t in (0.05, 0.2, 0.5, 0.9)]
    assert sizes == sorted(sizes, reverse=True)
    # exactly at the threshold is in
    assert "a.c" in {r["path"] for r in fl.select_fields(profile, threshold=0.2).collect()}


def test_column_names_collide_safely(spark):
    names = {r["path"]: r["column"] for r in fl.select_fields(
        _profile(spark, ['{"a":{"b_c":1,"B_C":2},"a_b":{"c":2},"l":[{"x":1}]}'])).collect()}
    assert names["a[0].x" if "a[0].x" in names else "l[0].x"] == "l_0__x"
    lowered = [c.lower() for c in names.values()]
    assert len(set(lowered)) == len(lowered)
    assert [names[p] for p in ("a.B_C", "a.b_c", "a_b.c")] == ["a_B_C", "a_b_c__2", "a_b_c__3"]


def test_groups(spark):
    df = spark.createDataFrame(
        [("metadata", '{"a":1,"m":1}'), ("journals", '{"a":1,"j":1}'), ("aac_x", '{"z":1}'), ("records", '{"r":1}')],
        "dataset string, value string",
    )
    profile = pt.profile(df).cache()
    selected = fl.select_fields(profile)
    union = {r["path"]: r["datasets"] for r in fl.combined_fields(selected, "elasticsearchaux").collect()}
    assert union == {"a": ["journals", "metadata"], "j": ["journals"], "m": ["metadata"]}
    assert [r[0] for r in fl.shared_fields(selected, profile, "elasticsearchaux").collect()] == ["a"]
    assert fl.shared_fields(selected, profile, "aac").count() == 0  # one active dataset only
    assert fl.combined_fields(selected, "elasticsearch").count() == 0
    report = [tuple(r)[:2] for r in fl.combined_report(fl.combined_fields(selected, "elasticsearchaux")).collect()]
    assert report == [(2, "a"), (1, "j"), (1, "m")]
    own = {(r["dataset"], r["path"]) for r in fl.fields_per_dataset(selected, "elasticsearchaux").collect()}
    assert ("digital_lending", "m") in own and ("journals", "m") in own and ("aac_x", "z") in own


def test_samples_are_repeatable(spark):
    df = spark.range(2000).select(F.lit("d").alias("dataset"), F.concat(F.lit("line "), "id").alias("value"))
    kept = sorted(r["value"] for r in pt.sample_rows(df, 0.2, seed=3).collect())
    # the same rows however they lie in partitions
    assert kept == sorted(r["value"] for r in pt.sample_rows(df.repartition(5), 0.2, seed=3).collect())
    assert 300 < len(kept) < 500 and pt.sample_rows(df, 0.2, seed=4).count() != 0
    files = spark.range(23).select(F.concat(F.lit("f"), "id").alias("path"),
                                   F.when(F.col("id") < 3, "few").otherwise("many").alias("dataset"))
    kept = pt.sample_files(files, 0.2).groupBy("dataset").count().collect()
    assert {r["dataset"]: r["count"] for r in kept} == {"few": 1, "many": 4}


def test_scaling_keeps_presence(spark):
    rows = _profile(spark, ['{"a":1}'] + ['{"b":1}'] * 2, rate=0.3).collect()
    assert {(r["path"], r["n_records"], r["total_records"], r["sampled_n"]) for r in rows} == {("a", 3, 10, 1), ("b", 7, 10, 2)}


def test_rates_per_dataset(spark):
    df = spark.createDataFrame([("a", '{"k":1}'), ("b", '{"k":1}')], "dataset string, value string")
    rows = pt.profile(df, {"a": 0.5, "b": 0.25}).collect()
    assert {(r["dataset"], r["n_records"], r["total_records"]) for r in rows} == {("a", 2, 2), ("b", 4, 4)}


def test_thresholds_are_exact(spark):
    for n, total in ((7, 35), (3, 15), (1, 5), (11, 55)):
        lines = ['{"k":1}'] * n + ["{}"] * (total - n)
        assert fl.select_fields(_profile(spark, lines)).count() == 1
        assert fl.select_fields(_profile(spark, [*lines, "{}"])).count() == 0


def test_wide_and_deep_records_are_profiled_in_seconds(spark):
    """Work follows the size of a record, and a dataset may have as many paths as records."""
    import time

    deep = "1"
    for level in range(20):
        deep = '{"l%d":%s%s}' % (level, deep, "".join(f',"k{i}":{{"x":"a{{"}}' for i in range(500)) if level == 10 else "")
    start = time.time()
    assert pt.count_paths(spark.createDataFrame([("d", deep)], "dataset string, value string")).count() == 1 + 20 + 1000
    ids = spark.range(100_000).select(F.lit("d").alias("dataset"), F.concat(F.lit('{"k'), "id", F.lit('":1}')).alias("value"))
    assert pt.profile(ids).agg(F.count("*"), F.min("sampled_total"), F.max("sampled_total")).first()[:] == (100_000,) * 3
    assert time.time() - start < 90


def test_files_drawn_by_size_estimate_without_bias(spark):
    """One file holds most of a dataset, in records of another kind than those of the many small ones."""
    sizes = [5000] + [10] * 40 + [200] * 5
    held = [(f"f{i}", n, "rare" if n == 200 else "large" if n > 1000 else "small") for i, n in enumerate(sizes)]
    files = spark.createDataFrame([("d", p, n) for p, n, _ in held] + [("one", "x", 7)], "dataset string, path string, length long")
    truth = {k: sum(n for _, n, kind in held if kind == k) for k in ("large", "small", "rare")}
    kind = {p: k for p, _, k in held}
    sums, draws = {k: [] for k in truth}, 200
    from functools import reduce
    all_seeds = reduce(lambda a, b: a.unionByName(b), [
        pt.sample_files_by_size(files, 0.2, seed).withColumn("seed", F.lit(seed)) for seed in range(draws)])
    rows = all_seeds.collect()
    for seed in range(draws):
        own = [r for r in rows if r["seed"] == seed]
        assert sum(r["dataset"] == "one" for r in own) == 1 and any(r["dataset"] == "d" for r in own)
        for k in truth:  # records: as many as bytes
            sums[k].append(sum(r["weight"] * r["length"] for r in own if kind.get(r["path"]) == k))
    for k, found in sums.items():
        mean = sum(found) / draws
        spread = (sum((x - mean) ** 2 for x in found) / draws) ** 0.5
        assert abs(mean - truth[k]) <= 4 * spread / draws ** 0.5 + 1e-6 * truth[k], (k, mean, truth[k])


def test_weights_make_shares(spark):
    lines = spark.createDataFrame([("d", '{"a":1}', 4.0), ("d", '{"a":1,"b":1}', 1.0), ("d", "bad", 9.0)],
                                  "dataset string, value string, weight double")
    got = {r["path"]: r for r in pt.profile(lines, weight="weight").collect()}
    assert (got["b"]["n_records"], got["b"]["total_records"], got["b"]["sampled_n"], got["b"]["share"]) == (1, 5, 1, 0.2)
    from quire.operators.fields import presence_report, select_fields
    assert {r["path"] for r in select_fields(pt.profile(lines, weight="weight"), 0.2).collect()} == {"a", "b"}
    assert {r["path"] for r in select_fields(pt.profile(lines, weight="weight"), 0.21).collect()} == {"a"}
    assert {r["path"]: r["presence_pct"] for r in presence_report(pt.profile(lines, weight="weight")).collect()} == {"a": 100.0, "b": 20.0}
