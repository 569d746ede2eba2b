import random

import pytest
from pyspark.sql import functions as F

from quire.operators import layout
from quire.operators.ordered import numbered, running_totals
from quire.sources import landing, readers
from quire.sources.files import move
from tests.conftest import plan_of


@pytest.mark.parametrize("block_rows", [1000, 150, 17, 1])
def test_parts_against_brute_force(spark, block_rows):
    random.seed(5)
    # one group holds most rows, one row is larger than the target, and one group is NULL
    rows = [(random.choice(["hot"] * 6 + ["b", None]), i * 3, "x" * random.choice([1, 5, 30, 400])) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, i bigint, t string")
    got = {(r["g"], r["i"]): r["part"]
           for r in layout.assign_parts(df, "g", "i", layout.line_bytes("t"), 100, block_rows).collect()}
    want, run = {}, {}
    for g, i, t in rows:
        run[g] = run.get(g, 0) + len(t) + 1
        want[(g, i)] = (run[g] - 1) // 100 + 1
    assert got == want


def test_parts_of_one_large_group(spark):
    rows = spark.range(100_000).select(F.lit("hot").alias("g"), "id", F.repeat(F.lit("x"), 500).alias("text"))
    parts = layout.assign_parts(rows, "g", "id", layout.line_bytes("text"), 5010, block_rows=9000)
    # the window sees the three narrow columns, never the text
    windows = [line for line in plan_of(parts, "extended").splitlines() if "Window [" in line]
    assert windows and not any("text" in line for line in windows)
    sizes = parts.groupBy("part").count().collect()
    assert len(sizes) == 10_000 and {r["count"] for r in sizes} == {10}


def test_running_totals_deal_one_group_over_blocks(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 9 > 0, "hot").alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    got = running_totals(rows, ["g"], [F.col("o").desc()], F.col("v"), "t", block_rows=400).collect()
    want, run = {}, {}
    for i in range(4999, -1, -1):
        g = "hot" if i % 9 else None
        run[g] = run.get(g, 0) + i % 7
        want[(g, i)] = run[g]
    assert {(r["g"], r["o"]): r["t"] for r in got} == want and len(got) == 5000
    place = {(r["g"], r["o"]): r["position"] for r in numbered(rows, ["g"], [F.col("o").asc()], block_rows=333).collect()}
    assert place[(None, 0)] == 1 and place[(None, 4995)] == 556 and place[("hot", 4999)] == 5000 - 556
    assert running_totals(rows.limit(0), ["g"], [F.col("o")], 1).count() == 0


def test_line_stats_count_bytes(spark):
    df = spark.createDataFrame([("a", "é"), ("a", "xy"), ("b", "")], "file_path string, value string")
    got = {r["file_path"]: tuple(r)[1:] for r in layout.line_stats(df).collect()}
    assert got == {"a": (2, 6, 3.0), "b": (1, 1, 1.0)}


def test_resize(spark):
    df = spark.range(1000).select(F.lit("x" * 99).alias("value"))
    assert layout.resize(df, 10_000).rdd.getNumPartitions() == 10
    assert layout.resize(df.limit(0), 10_000).count() == 0


def _table(spark, path):
    """Small files of two bases, one of them with an extra column."""
    a = spark.range(0, 300, 1, 6).select(F.col("id").cast("string").alias("_id"), F.lit("a").alias("c"))
    b = spark.range(300, 320, 1, 2).select(F.col("id").cast("string").alias("_id"), F.lit("b").alias("d"))
    a.write.parquet(f"{path}/records_x")
    b.write.parquet(f"{path}/journals_x")
    return landing.list_files(spark, path, "*.parquet")


@pytest.mark.parametrize("by", ["directory", "base", "none"])
def test_compaction_keeps_every_row(spark, tmp_path, by):
    files = _table(spark, str(tmp_path / "in"))
    before = files.count()
    out = str(tmp_path / "out")
    report = layout.compact(spark, files, out, by=by)
    assert report.pop("files_out") <= before
    assert report == {"files_in": before, "rows_in": 320, "rows_out": 320}
    df = readers.read_shredded(spark, out, merge_schema=True)
    ids = [r["_id"] for r in df.collect()]
    assert sorted(ids, key=int) == [str(i) for i in range(320)]
    assert df.filter("c = 'a'").count() == 300 and df.filter("d = 'b'").count() == 20
    assert files.count() == before  # inputs stay
    if by == "none":
        assert landing.list_files(spark, out, "*.parquet").count() == 1


def test_compaction_keeps_partition_columns_and_merges_own_files(spark, tmp_path):
    rows = spark.range(0, 6000, 1, 6).select(
        F.col("id").cast("string").alias("_id"),
        F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("dataset"))
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.write.partitionBy("dataset").parquet(path)
    files = landing.list_files(spark, path, "*.parquet")
    hot = files.filter(F.col("path").contains("dataset=hot")).agg(F.sum("length")).first()[0]
    report = layout.compact(spark, files, out, target_bytes=hot // 2 + 1)
    assert report["files_in"] == 12 and report["files_out"] <= 3
    df = readers.read_shredded(spark, out)
    assert df.columns == ["_id", "dataset"]
    assert {r["dataset"]: r["count"] for r in df.groupBy("dataset").count().collect()} == {"small": 600, "hot": 5400}


def test_every_file_is_placed_whole_and_evenly():
    random.seed(3)
    files = [(f"p{i:03d}", random.choice(["a", "a", "a", "b", "c"]), random.choice([1, 10, 90, 5000]), random.randint(1, 40))
             for i in range(200)] + [("only", "d", 7, 3)]
    placed, slots = layout.place_files(files, 2000)
    assert sorted(p.path for p in placed) == sorted(f[0] for f in files)
    fill = {}
    for p in placed:
        assert p.total == sum(f[2] for f in files if f[1] == p.group) and p.count == -(-p.total // 2000)
        for row in range(p.rows):
            at = p.before + p.length * (row + 0.5) / p.rows
            slot = p.first + min(p.count - 1, int(at * p.count / p.total))
            assert p.first <= slot < p.first + p.count
            fill[(p.group, slot)] = fill.get((p.group, slot), 0) + p.length / p.rows
    groups = {slot: group for group, slot in fill}
    assert len(groups) == len(fill) and slots == max(groups) + 1
    for (group, _), size in fill.items():
        whole = next(p for p in placed if p.group == group)
        assert abs(size - whole.total / whole.count) <= 2 * 5000  # a row at each end


@pytest.mark.parametrize("by", ["directory", "base"])
def test_output_files_are_of_one_size(spark, tmp_path, by):
    rng = random.Random(8)
    for n, rows in enumerate([40_000, 300, 9_000, 1, 2_500, 15_000, 700, 60]):  # files as uneven as they come
        text = [("%032x" % rng.getrandbits(128),) for _ in range(rows)]
        folder = f"{tmp_path}/made{n}"
        spark.createDataFrame(text, "_id string").coalesce(1).write.parquet(folder)
        part = landing.list_files(spark, folder, "*.parquet").first()["path"]
        move(spark, part, f"{tmp_path}/in/journals_x_{n}.parquet")
    small = spark.range(50).select(F.col("id").cast("string").alias("_id")).coalesce(1)
    small.write.parquet(f"{tmp_path}/last")
    part = landing.list_files(spark, f"{tmp_path}/last", "*.parquet").first()["path"]
    move(spark, part, f"{tmp_path}/in/metadata_x_0.parquet")
    listing = landing.list_files(spark, f"{tmp_path}/in", "*.parquet")
    target = listing.agg(F.sum("length")).first()[0] // 6
    report = layout.compact(spark, listing, str(tmp_path / "out"), target_bytes=target, by=by)
    assert report["rows_in"] == 67_611 and report["files_in"] == 9
    sizes = [(r["path"], r["length"]) for r in landing.list_files(spark, str(tmp_path / "out"), "*.parquet").collect()]
    large = [n for p, n in sizes if "base=metadata_x" not in p]
    assert len(large) >= 6 and all(abs(n - sum(large) / len(large)) < 0.25 * sum(large) / len(large) for n in large)
    assert len(sizes) == report["files_out"] and (by == "directory" or len(sizes) == len(large) + 1)
    if by == "base":
        got = {r["base"]: r["count"] for r in readers.read_shredded(spark, str(tmp_path / "out")).groupBy("base").count().collect()}
        assert got == {"journals_x": 67_561, "metadata_x": 50}


def test_paths_with_odd_characters_are_compacted(spark, tmp_path):
    folder = str(tmp_path / "in" / "a b+c%20")
    spark.range(0, 90, 1, 3).write.parquet(folder)
    report = layout.compact(spark, landing.list_files(spark, folder, "*.parquet"), str(tmp_path / "out"))
    assert report == {"files_in": 3, "files_out": 1, "rows_in": 90, "rows_out": 90}


def test_small_parts_share_tasks_and_are_files_all_the_same(spark, tmp_path):
    df = spark.range(1000).select(F.concat(F.lpad(F.col("id").cast("string"), 4, "0"), F.lit("x" * 95)).alias("value"))
    assert layout.resize(df, 1000, most=7).rdd.getNumPartitions() == 7
    out = str(tmp_path / "out")
    layout.write_resized(df, out, 1000, most=7)
    files = [r["length"] for r in landing.list_files(spark, out, "part-*").collect()]
    assert 100 <= len(files) <= 107 and max(files) == 1000
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == sorted(r["value"] for r in df.collect())


def test_rows_to_be_merged_travel_once(spark, tmp_path):
    files = _table(spark, str(tmp_path / "in"))
    rows = spark.read.parquet(*[r["path"] for r in files.collect()])
    counted = rows.groupBy(F.col("_metadata.file_path").alias("path")).count().collect()
    placed, _ = layout.place_files([(r["path"], "g", 100, r["count"]) for r in counted], 300)
    plan = plan_of(layout._dealt(rows, placed), "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_compaction_reads_few_rows_a_task_and_restores_the_setting(spark, tmp_path, monkeypatch):
    spark.range(0, 400_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("_id")).write.parquet(str(tmp_path / "in"))
    files, asked = landing.list_files(spark, str(tmp_path / "in"), "*.parquet"), []
    real = type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: (asked.append((k, v)), real(self, k, v))[1])
    monkeypatch.setattr(layout, "MERGED_ROWS", 50_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    layout.compact(spark, files, str(tmp_path / "out"))
    total = files.agg(F.sum("length")).first()[0]
    assert ("spark.sql.files.maxPartitionBytes", str(total // 8)) in asked
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
