"""Zone maps and seekable files."""

import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from quire.sources import landing, readers, seekable, zones


def test_a_lookup_opens_at_most_two_files_of_a_hundred(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("_id"), F.col("id").alias("n"))
    counts = zones.write_clustered(df, path, "_id", 100)
    files = landing.list_files(spark, path, "part-*.parquet").count()
    assert counts == {"rows": 20_000} and files >= 90
    for n in (0, 77, 19_999):
        wanted = df.filter(F.col("n") == n).first()["_id"]
        hit = zones.lookup(spark, path, "_id", [wanted])
        assert [r["n"] for r in hit.collect()] == [n] and len(hit.inputFiles()) <= 2
        assert len(readers.read_shredded(spark, path).filter(F.col("_id") == wanted).inputFiles()) == files
    some = [r["_id"] for r in df.filter("n % 4000 = 1").collect()]
    hit = zones.lookup(spark, path, "_id", [*some, None, "no such id"])
    assert sorted(r["n"] for r in hit.collect()) == [1, 4001, 8001, 12001, 16001] and len(hit.inputFiles()) <= 12
    assert zones.lookup(spark, path, "_id", ["~"]).count() == zones.lookup(spark, path, "_id", [None]).count() == 0
    assert zones.lookup(spark, path, "_id", ["~"]).columns == ["_id", "n"]
    zone = spark.read.parquet(f"{path}/{zones.ZONES}").agg(F.sum("n_rows").alias("n"), F.count(F.lit(1)).alias("f")).first()
    assert tuple(zone) == (20_000, files) and readers.read_shredded(spark, path).count() == 20_000


def test_a_frequent_key_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 9 == 1, None).otherwise(
        F.col("id").cast("string")).alias("_id"), F.col("id").alias("n"))
    zones.write_clustered(df, path, "_id", 12)
    hit = zones.lookup(spark, path, "_id", ["hot"])
    assert hit.count() == 3000 and len(hit.inputFiles()) >= 5  # not all of it in one file
    assert zones.lookup(spark, path, "_id", ["5"]).count() == 1
    assert readers.read_shredded(spark, path).filter("_id is null").count() == df.filter("_id is null").count()


def seekable_file(path, text, cuts, checksums=False):
    """A file with one frame for each stretch of ``text`` between ``cuts``, and a seek table."""
    out, entries = b"", b""
    for a, b in zip([0, *cuts], [*cuts, len(text)]):
        frame = zstandard.ZstdCompressor().compress(text[a:b])
        out += frame
        entries += struct.pack("<II", len(frame), b - a) + (b"\0\0\0\0" if checksums else b"")
    footer = struct.pack("<IBI", len(cuts) + 1, 0x80 if checksums else 0, 0x8F92EAB1)
    out += struct.pack("<II", 0x184D2A5E, len(entries) + len(footer)) + entries + footer
    path.write_bytes(out)
    return str(path)


@pytest.mark.parametrize("target", [1, 40, 300, 10**9])
def test_every_line_is_read_once(tmp_path, target):
    rng = random.Random(target)
    for case in range(60):
        lines = [("é" * rng.choice([0, 1, 5, 200]) + str(i)).encode() if rng.random() < 0.9 else b"" for i in range(rng.randint(0, 40))]
        text = b"\n".join(lines) + rng.choice([b"", b"\n", b"\n\n"])
        ends = [i + 1 for i, c in enumerate(text) if c == 10]
        cuts = sorted(rng.choice([rng.randint(0, len(text)), *(ends[:20] or [0])]) for _ in range(rng.randint(0, 12)))
        path = seekable_file(tmp_path / f"{case}.zst", text, cuts, checksums=case % 2 == 0)
        assert seekable.frames(path) is not None
        got = [line for r in seekable.ranges(path, target) for batch in seekable.lines_of(r) for line in batch]
        want = text.split(b"\n")
        assert got == (want[:-1] if want[-1] == b"" else want)


def test_one_file_is_several_tasks(spark, tmp_path):
    lines = [f'{{"aacid":"{i}","metadata":{{"t":"é{i}"}}}}' for i in range(5000)]
    text = ("\n".join(lines) + "\n").encode()
    cuts = list(range(10_000, len(text), 10_000))
    one = seekable_file(tmp_path / "x_meta__aacid__coll__1.jsonl.seekable.zst", text, cuts)
    plain = tmp_path / "x_meta__aacid__coll__2.jsonl.zst"
    plain.write_bytes(zstandard.ZstdCompressor().compress(b"last\n"))
    assert seekable.frames(str(plain)) is None and seekable.frames(one) is not None
    split = seekable.read_seekable_lines(spark, [one], target_bytes=50_000)
    assert split.rdd.getNumPartitions() > 3
    whole = readers.read_lines(spark, [one])
    assert sorted(r["value"] for r in split.select("value").collect()) == sorted(r["value"] for r in whole.select("value").collect())
    assert split.select("dataset").distinct().collect()[0][0] == "aac_coll"
    both = seekable.read_seekable_lines(spark, [one, str(plain)], target_bytes=50_000)
    assert both.count() == 5001 and both.columns == whole.columns
    (tmp_path / "short.zst").write_bytes(b"x")
    assert seekable.frames(str(tmp_path / "short.zst")) is None
