"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Two suffixes are equal through ``WIDTH`` bytes exactly when the strings that start there repeat. Nothing deeper is
ever compared, and a group of suffixes that a pass leaves alone is done. Passes go from the most significant digit:

1. *Anchor.* Among the ``WIDTH - K + 1`` strings of ``K`` bytes inside a window, the one with the smallest hash (the
   leftmost of equals) is the window's anchor. Equal windows have equal anchors at equal offsets, so windows fall
   into groups by anchor. Neighbouring windows of a text mostly share theirs; such a *run* of windows is one row,
   about one for 185 bytes of text. A group with one run holds no repeat.
2. *Run.* Inside a group, runs with equal bytes repeat whole: all their windows are done.
3. *Part.* What is left are groups with several kinds of runs, as at the edges of a repeat. One run of each kind is cut
   into parts of ``PART`` windows at fixed distances from the anchor. A part whose *core* - the bytes that all its
   windows share - is alone holds no repeat; parts with equal bytes repeat whole.
4. *Window.* The windows of parts that are neither are told apart through the full depth.

``unit=CODED`` runs the same passes over texts as sequences of words, eight bytes of hash for each, with widths in words.

Equality is that of hashes of the compared bytes, 64 bits within an anchor's group, whose name has 64 bits more. Every
step is keyed by hashes, counts are combined before shuffles, and lists are gathered for one document only, so a
passage that a third of all documents hold is not gathered anywhere.

Defined cases: a null text is empty; texts under ``WIDTH`` bytes have nothing to remove; rows repeated in full are
places of their own, so they lose all their windows; an empty table gives an empty result; other columns, of
any name, pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import bytes_of, fresh, table, written

WIDTH = 400
SEGMENT = 1 << 23  # window starts of a long text that are looked at together; a limit on memory only
MASK = (1 << 24) - 1  # places within a segment

CODED = 8  # bytes that stand for a word
PART = 10  # windows in a part; about two parts of an open run stay open, so few windows are left
WORD_PART = 5  # the same for windows of words

_RUNS = "u1 long, u2 int, k long, h long, lo int, hi int, at int, n int"
_CONTEXT = "u1 long, u2 int, k long, lo int, hi int, at int, bytes binary"
REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def gram(width: int, unit: int = 1) -> int:
    """Bytes (words) in an anchor for a window of ``width`` bytes (words)."""
    return 8 * max(1, min(4, width // 16)) if unit == 1 else max(1, min(8, width // 4))


def word_codes(text: bytes) -> bytes:
    """The hashes of the words, one after the other."""
    from xxhash import xxh3_64_intdigest

    words = text.split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)).tobytes()


def word_bounds(text: bytes) -> np.ndarray:
    """First byte of each word and the byte after it, as ``bytes.split`` has them."""
    blank = np.isin(np.frombuffer(text, np.uint8), list(b" \t\n\r\v\f"))
    return np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]))).reshape(-1, 2)


def _units(text: bytes, unit: int) -> bytes:
    return text if unit == 1 else word_codes(text)


def _mixed(words: np.ndarray, k: int, step: int = 8) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes from each place; ``words`` holds the ``step`` bytes from each place."""
    size = len(words) - (k - step)
    out = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, k, step):
            out = (out ^ words[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def anchors(text: bytes, width: int, unit: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of windows with the same anchor, segment by segment: first start, last start, anchor, anchor hash."""
    k = gram(width, unit)
    span = width - k + 1
    for base in range(0, len(text) // unit - width + 1, SEGMENT):
        part = text[base * unit:(base + SEGMENT + width - 1) * unit]
        n = len(part) // unit
        if unit == 1:
            words = np.empty(n - 7, np.uint64)
            for r in range(min(8, n - 7)):
                count = (n - r) // 8
                words[r::8] = np.frombuffer(part, "<u8", count, r)[:len(words[r::8])]
            hashes = _mixed(words, k)
        else:
            hashes = _mixed(np.frombuffer(part, "<u8"), k, 1)
        keys = (hashes & np.uint64(~MASK & (1 << 64) - 1)) | np.arange(len(hashes), dtype=np.uint64)
        # smallest key of each `span` neighbours: blocks of `span`, running minima from both ends
        blocks = np.full(-(-len(keys) // span) * span, np.iinfo(np.uint64).max, np.uint64)
        blocks[:len(keys)] = keys
        blocks = blocks.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - width + 1
        place = (np.minimum(behind[:windows], ahead[span - 1:span - 1 + windows]) & np.uint64(MASK)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        last = np.concatenate([first[1:] - 1, [windows - 1]])
        yield first + base, last + base, place[first] + base, hashes[place[first]]


def _merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Union of ``(start, end)`` rows as maximal disjoint spans."""
    if not len(spans):
        return []
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    at = np.flatnonzero(new)
    return list(zip(spans[at, 0].tolist(), reach[np.concatenate([at[1:] - 1, [len(spans) - 1]])].tolist()))


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _hash(data) -> int:
    """Signed 64-bit hash of bytes."""
    from xxhash import xxh3_64_intdigest

    code = xxh3_64_intdigest(data)
    return code - (code >> 63 << 64)


def _runs(width: int, unit: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each kind of run in a document. A kind that a document itself holds twice is done: its rows
        have ``n`` over one, and the bytes it covers come as rows without ``k``."""
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for u1, u2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bytes_of(batch.column(2))):
                text = _units(text, unit)
                if len(text) < width * unit:
                    continue
                view = memoryview(text)
                kinds: dict[tuple, list] = {}
                for firsts, lasts, places, hashes in anchors(text, width, unit):
                    hashes = hashes.view(np.int64).tolist()
                    for lo, hi, at, k in zip(firsts.tolist(), lasts.tolist(), places.tolist(), hashes):
                        kinds.setdefault((k, _hash(view[lo * unit:(hi + width) * unit]), hi - lo), []).append((lo, hi, at))
                own = []
                for (k, h, _), runs in kinds.items():
                    for column, value in zip(out, (u1, u2, k, h, *runs[0], len(runs))):
                        column.append(value)
                    if len(runs) > 1:
                        own += [(lo, hi + width) for lo, hi, _ in runs]
                for lo, end in _merged(np.array(own, np.int64).reshape(-1, 2)):
                    for column, value in zip(out, (u1, u2, None, None, lo, end, None, None)):
                        column.append(value)
                if len(out[0]) > 50_000:
                    yield _batch(out, _RUNS)
                    out = [[] for _ in range(8)]
            yield _batch(out, _RUNS)

    return run


def _contexts(width: int, unit: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the named runs."""
        for batch in batches:
            for i in range(batch.num_rows):
                u1, u2, runs = (batch.column(c)[i].as_py() for c in (0, 1, 3))
                text = _units(bytes_of(batch.column(2).slice(i, 1))[0], unit)
                rows = [(u1, u2, x["k"], x["lo"], x["hi"], x["at"], text[x["lo"] * unit:(x["hi"] + width) * unit]) for x in runs]
                yield _batch(list(zip(*rows)), _CONTEXT)

    return run


def _parts(width: int, part: int, unit: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of runs. Part ``j`` has the windows that begin ``j * part`` to ``j * part + part - 1`` before the anchor;
        ``core`` is what they share, ``whole`` all they cover with the part's own bounds."""
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for rid, k, lo, hi, at, data in zip(*[batch.column(c).to_pylist() for c in ("rid", "k", "lo", "hi", "at", "bytes")]):
                view = memoryview(data)
                for j in range((at - hi) // part, (at - lo) // part + 1):
                    near, far = j * part, j * part + part - 1  # before the anchor
                    core = view[max(0, at - near - lo) * unit:(at - far - lo + width) * unit]
                    first, last = max(lo, at - far), min(hi, at - near)
                    whole = _hash(view[(first - lo) * unit:(last - lo + width) * unit]) ^ (at - first) ^ (at - last) << 32
                    for column, value in zip(out, (rid, k, j, _hash(core), whole, last - first + 1)):
                        column.append(value)
            yield _batch(out, "rid long, k long, j int, core long, whole long, n int")

    return run


def _windows(width: int, part: int, unit: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each window of the named parts; ``o`` is how far before the anchor it begins."""
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            columns = [batch.column(c).to_pylist() for c in ("rid", "k", "lo", "hi", "at", "bytes", "js")]
            for rid, k, lo, hi, at, data, js in zip(*columns):
                view = memoryview(data)
                for j in js:
                    for p in range(max(lo, at - j * part - part + 1), min(hi, at - j * part) + 1):
                        for column, value in zip(out, (k, _hash(view[(p - lo) * unit:(p - lo + width) * unit]), rid, at - p)):
                            column.append(value)
                if len(out[0]) > 100_000:
                    yield _batch(out, "k long, w long, rid long, o int")
                    out = [[] for _ in range(4)]
            yield _batch(out, "k long, w long, rid long, o int")

    return run


def _covered(width: int, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merged byte spans of the windows and parts of each run that repeat."""
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            columns = [batch.column(c).to_pylist() for c in ("u1", "u2", "lo", "hi", "at", "os", "js")]
            for u1, u2, lo, hi, at, windows, parts in zip(*columns):
                spans = [(at - o, at - o + width) for o in windows or []]
                spans += [(max(lo, at - j * part - part + 1), min(hi, at - j * part) + width) for j in parts or []]
                for start, end in _merged(np.array(spans, np.int64)):
                    for column, value in zip(out, (u1, u2, start, end)):
                        column.append(value)
            yield _batch(out, "u1 long, u2 int, lo int, end int")

    return run


def named(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents with the 96-bit name of their id and text, by which spans find them again."""
    return docs.withColumns({
        fresh(docs, "name1"): F.xxhash64(F.col(id_column), F.col(text_column)),
        fresh(docs, "name2"): F.hash(F.lit(7), F.col(text_column), F.col(id_column)),
    })


def repeated_spans(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text",
                   part: int | None = None, unit: int = 1) -> DataFrame:
    """``u1, u2, spans``: for each named document with repeats, the spans covered by them (not yet merged), in bytes, or
    in words with ``unit=CODED``."""
    part = part or (PART if unit == 1 else WORD_PART)
    texts = named(docs.select(id_column, F.col(text_column).cast("string").alias(text_column)), id_column, text_column)
    texts = texts.toDF("id", "text", "u1", "u2").select("u1", "u2", "text")
    rows = written(texts.mapInArrow(_runs(width, unit), _RUNS), "runs")
    within = rows.filter("k IS NULL").select("u1", "u2", "lo", F.col("hi").alias("end"))
    # pass 1: groups of one run are done
    runs = rows.filter("k IS NOT NULL")
    again = runs.groupBy("k").agg(F.sum("n").alias("c")).filter("c > 1").select("k")
    runs = written(runs.join(again, "k"), "runs")
    # pass 2: runs of a kind that occurs again are done
    place = F.struct("u1", "u2", "lo", "hi", "at")
    kinds = runs.groupBy("k", "h").agg(F.sum("n").alias("n"), F.min(place).alias("run"))
    kinds = written(kinds, "kinds")
    whole = runs.join(kinds.filter("n > 1").select("k", "h"), ["k", "h"])
    whole = whole.select("u1", "u2", "lo", (F.col("hi") + width).alias("end"))
    mixed = kinds.groupBy("k").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("k")
    asked = kinds.join(mixed, "k").select("k", "run.*")
    asked = asked.groupBy("u1", "u2").agg(F.collect_list(F.struct("k", "lo", "hi", "at")).alias("runs"))
    looked = texts.join(asked, ["u1", "u2"])
    contexts = looked.select("u1", "u2", "text", "runs").mapInArrow(_contexts(width, unit), _CONTEXT)
    # rows repeated in full bring equal contexts; all their windows do repeat
    contexts = written(contexts.withColumn("rid", F.monotonically_increasing_id()), "contexts")
    # pass 3
    parts = contexts.mapInArrow(_parts(width, part, unit), "rid long, k long, j int, core long, whole long, n int")
    parts = written(parts, "parts")
    shared = parts.groupBy("k", "j", "core").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("k", "j", "core")
    twice = parts.groupBy("k", "j", "whole").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("k", "j", "whole")
    done = parts.join(twice, ["k", "j", "whole"])
    open_parts = parts.join(shared, ["k", "j", "core"])
    # pass 4: parts that repeat whole are looked at as well, for others to be compared with
    open_parts = open_parts.groupBy("rid").agg(F.collect_list("j").alias("js"))
    windows = contexts.drop("u1", "u2").join(open_parts, "rid")
    windows = written(windows.mapInArrow(_windows(width, part, unit), "k long, w long, rid long, o int"), "windows")
    again = windows.groupBy("k", "w").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("k", "w")
    # what repeats of each run: at most as many entries as the run has windows and parts
    single = windows.join(again, ["k", "w"]).groupBy("rid").agg(F.collect_list("o").alias("os"))
    single = written(single, "single")
    done = done.groupBy("rid").agg(F.collect_list("j").alias("js"))
    runs_left = contexts.select("rid", "u1", "u2", "lo", "hi", "at").join(single, "rid", "left").join(done, "rid", "left")
    edges = runs_left.filter("os IS NOT NULL OR js IS NOT NULL").mapInArrow(
        _covered(width, part), "u1 long, u2 int, lo int, end int")
    spans = whole.unionByName(within).unionByName(edges)
    return written(spans.groupBy("u1", "u2").agg(F.collect_list(F.struct("lo", "end")).alias("spans")), "spans")


def with_spans(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text",
               words: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` and, last, their repeated byte spans (null: none); with ``words``, after them the
    spans in words that repeats of so many words cover."""
    spans = repeated_spans(docs, width, id_column, text_column)
    if words:
        more = repeated_spans(docs, words, id_column, text_column, unit=CODED)
        spans = spans.join(more.withColumnRenamed("spans", "word_spans"), ["u1", "u2"], "full")
    keyed = named(docs, id_column, text_column)
    name1, name2 = keyed.columns[-2:]
    spans = spans.toDF(name1, name2, *[fresh(docs, c) for c in spans.columns[2:]])
    return keyed.join(spans, [name1, name2], "left").drop(name1, name2)


def _kept(text: bytes, spans: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    merged = _merged(spans)
    edges = [0, *[x for span in merged for x in span], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), merged


def digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """What is removed, a digest of what is left, and what is left as text (without bytes of characters cut apart)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, spans in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1)), batch.column(2).to_pylist()):
                pairs = np.array([(s["lo"], s["end"]) for s in spans or []], np.int64).reshape(-1, 2)
                left, merged = _kept(text, pairs)
                rows.append((key, len(text), len(text) - len(left), len(merged), hashlib.sha256(left).hexdigest(),
                             left.decode(errors="ignore")))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                             [f.split()[0] for f in REMOVED.split(", ")])

    found = with_spans(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), width)
    return found.mapInArrow(run, REMOVED)


def _left(text: str, edges, word_edges) -> str:
    data = text.encode()
    spans = np.asarray([] if edges is None else edges, np.int64).reshape(-1, 2)
    if word_edges is not None:
        bounds, words = word_bounds(data), np.asarray(word_edges).reshape(-1, 2)
        spans = np.concatenate([spans, np.stack([bounds[words[:, 0], 0], bounds[words[:, 1] - 1, 1]], axis=1)])
    return _kept(data, spans)[0].decode(errors="ignore")


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, edges: pd.Series, word_edges: pd.Series) -> pd.Series:
    """Texts without the bytes between each two edges and without the words between each two word edges."""
    return pd.Series([t if t is None or e is None and w is None else _left(t, e, w)
                      for t, e, w in zip(texts, edges, word_edges)], dtype=object)


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text",
                   words: int | None = None) -> DataFrame:
    """``docs`` with repeated bytes taken out of the text: strings of ``width`` bytes and, if asked for, passages of
    ``words`` words, whatever blanks stand between them. Both are told on the texts as given. Bytes of a character that
    was cut apart go with it; a null text stays null. Other columns are as they were."""

    found = with_spans(docs, width, id_column, text_column, words)
    columns = [F.col(c) for c in found.columns[len(docs.columns):]]
    edges = [F.flatten(F.transform(c, lambda x: F.array(x["lo"], x["end"]))) for c in columns]
    if not words:
        edges.append(F.lit(None).cast("array<int>"))
    left = F.when(F.coalesce(*columns).isNull(), F.col(text_column)).otherwise(_cut(F.col(text_column), *edges))
    return found.withColumn(text_column, left).select(*docs.columns)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that start anywhere else."""
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
SQL: dict[str, str] = {}
