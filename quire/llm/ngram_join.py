"""Jaccard join of documents on word n-grams by signature trees, and the components of its links.

A document is the set of its distinct 4-word shingles. Two documents link when
``100 * |intersection| >= 85 * |union|``; a component is what links reach.

* Equal sets are one node, named by a 64-bit hash (a collision stops the run). Copies are never paired.
* Linked sets share a shingle among the first ``n - ceil(0.85 n) + 1`` of each in any common order. The order puts
  shingles with full buckets last; loads are counted over all documents in a fixed number of buckets, so a passage
  that very many documents share does not bring them together. The order changes the work, never the result.
* A block is the nodes that share such a shingle. Blocks with the same nodes are kept once.
* Inside a block nodes form a *signature tree*: sorted by size and smallest shingle, leaves of eight, four children
  to a node; a node holds the OR of its sets' token bitmaps, its size range and the most tokens that share a bit. Two
  trees are walked together: a pair of nodes is cut off when the largest possible overlap of any two of their sets
  is below what a link needs, when their sizes are too far apart, or when all below is connected already. What is left
  is compared exactly.
* Before any set is moved, nodes walk the trees with their signatures alone, four to eight bits a shingle. A node without
  a partner that the signatures allow has no link and leaves; so do nodes of a block whose sizes are too far from all
  others'. What stays is near copies, mostly. Round two does the same between components.
* Round one takes each node to its largest block only, which connects most near copies at the cost of one copy of
  their sets. Round two takes every block that still spans components, so every possible link is either compared or
  between connected nodes. Large blocks are cut into parts, and every pair of parts meets in round two.

Defined cases: null and empty texts, and texts of white space, have no shingles, link with nothing, and are their
own component; texts under four words are one shingle of the whole sequence; repeated rows are copies; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import bytes_of, fresh, table, written

SHINGLE = 4
PERCENT = 85
BUCKETS = 1 << 18  # bounds what the driver and each worker hold of the loads: 2 MB
PART = 2000  # nodes of a block in one task and tree
LEAF, FAN = 8, 4

_DOC = "doc_id long, t long, n long, s long, s2 long, keys array<long>, signature binary"


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. ``bytes.lower`` and ``bytes.split`` know ASCII only."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    size = len(words) - width + 1
    out = np.full(size, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = (out ^ codes[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def loads(texts: DataFrame, width: int = SHINGLE) -> np.ndarray:
    """How many shingles of documents fall into each bucket, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                sets = [shingles(t, width) for t in bytes_of(batch.column(0).slice(lo, 256))]
                total += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "c"])

    counts = texts.mapInArrow(count, "bucket int, c long").groupBy("bucket").agg(F.sum("c").alias("c"))
    found = counts.toArrow()  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("c").to_numpy()
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _documents(load, width: int, percent: int):
    from xxhash import xxh3_128_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = load.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                sizes, names, keys, signatures = [], [], [], []
                for text in bytes_of(part.column(2)):
                    own = shingles(text, width)
                    sizes.append(len(own))
                    names.append(xxh3_128_intdigest(own.tobytes()))
                    first = np.lexsort((own, weight[_bucket(own)]))[:prefix_length(len(own), percent) if len(own) else 0]
                    keys.append(own[first].view(np.int64))
                    signatures.append(signature(own, bits_for(len(own))).tobytes())
                low = np.array([x & (1 << 64) - 1 for x in names], np.uint64).view(np.int64)
                high = np.array([x >> 64 for x in names], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(low), pa.array(high),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                    ["doc_id", "t", "n", "s", "s2", "keys", "signature"])

    return run


def bits_for(n: int) -> int:
    """Bits of the bitmap of ``n`` tokens: a power of two, four to eight times as many."""
    return max(64, 8 << max(0, n.bit_length() - 1))


def signature(members: np.ndarray, bits: int) -> np.ndarray:
    """Bitmap of a set's tokens. Halves of a bitmap OR-ed together are the bitmap of half as many bits."""
    flags = np.zeros(bits, np.uint8)
    flags[(members & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags)


def folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap of ``size`` bytes from a larger one."""
    return np.bitwise_or.reduce(np.frombuffer(bitmap, np.uint8).reshape(-1, size), axis=0)


class Tree:
    """A signature tree over sets given by bitmap, size and one token; ``order`` lists them from left to right."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, tokens: np.ndarray):
        self.order = np.lexsort((tokens, sizes))
        sizes = sizes[self.order]
        bits = bitmaps[self.order].view(np.uint64)
        shared = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        # levels from single sets up to one root: bitmap, smallest and largest size, most tokens lost to shared bits
        self.levels = [(bits, sizes, sizes, shared)]
        while len(self.levels[-1][0]) > 1:
            b, small, large, lost = self.levels[-1]
            fan = LEAF if len(self.levels) == 1 else FAN
            at = np.arange(0, len(b), fan)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(small, at),
                                np.maximum.reduceat(large, at), np.maximum.reduceat(lost, at)))

    def fan(self, level: int) -> int:
        return LEAF if level == 1 else FAN


class Forest:
    """Union-find over a block's nodes."""

    def __init__(self, labels: list):
        first: dict = {}
        self.parent = np.array([first.setdefault(x, i) for i, x in enumerate(labels)])

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return self.parent
            self.parent = up

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def walk(tree: Tree, settled, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places that the dual traversal leaves, ``a <= b``.

    ``settled()`` gives arrays with a number for each set in the tree's order; a pair of nodes below which all have the
    same number in one of them, not negative, is cut off.
    """
    a = b = np.zeros(1, np.int64)
    none = np.empty(0, np.int64)
    for level in range(len(tree.levels) - 1, -1, -1):
        bits, small, large, lost = tree.levels[level]
        ranges = []
        for lowest in settled():
            highest = lowest
            for l in range(1, level + 1):
                at = np.arange(0, len(lowest), tree.fan(l))
                lowest, highest = np.minimum.reduceat(lowest, at), np.maximum.reduceat(highest, at)
            ranges.append(np.where(lowest == highest, lowest, -1))
        keep_a, keep_b = [none], [none]
        for lo in range(0, len(a), 1 << 15):
            i, j = a[lo:lo + (1 << 15)], b[lo:lo + (1 << 15)]
            go = np.ones(len(i), bool)
            for same in ranges:
                go &= (same[i] != same[j]) | (same[i] < 0)
            go &= (100 * large[i] >= percent * small[j]) & (100 * large[j] >= percent * small[i])
            i, j = i[go], j[go]
            overlap = np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64) + np.minimum(lost[i], lost[j])
            overlap = np.minimum(overlap, np.minimum(large[i], large[j]))
            go = (100 + percent) * overlap >= percent * (small[i] + small[j])
            keep_a.append(i[go])
            keep_b.append(j[go])
        a, b = np.concatenate(keep_a), np.concatenate(keep_b)
        if level == 0 or not len(a):
            break
        fan, below = tree.fan(level), len(tree.levels[level - 1][0])
        ca = (a[:, None] * fan + np.arange(fan)).repeat(fan, axis=1).ravel()
        cb = np.tile(b[:, None] * fan + np.arange(fan), (1, fan)).ravel()
        inside = (ca < below) & (cb < below) & (ca <= cb)
        a, b = ca[inside], cb[inside]
    return a[a != b], b[a != b]


def partners(signatures: list[bytes], sizes: np.ndarray, names: np.ndarray, labels: np.ndarray,
             percent: int = PERCENT) -> np.ndarray:
    """Whether the signatures allow each set a link to another one of the block with another label.

    Sets are taken by powers of two of their size, each together with those of the next power that are near enough, so
    bitmaps in one tree have one length that suits them.
    """
    found = np.zeros(len(sizes), bool)
    power = np.array([int(n).bit_length() for n in sizes])
    for p in np.unique(power).tolist():
        rows = np.flatnonzero((power == p) | ((power == p + 1) & (percent * sizes < 100 * (1 << p))))
        if len(rows) < 2:
            continue
        size = min(len(signatures[i]) for i in rows)
        tree = Tree(np.stack([folded(signatures[i], size) for i in rows]), sizes[rows], names[rows])
        rows = rows[tree.order]
        _, own = np.unique(labels[rows], return_inverse=True)
        # neighbours in the order first; pairs of nodes that all have a partner need no look
        n, (bits, _, _, lost) = sizes[rows], tree.levels[0]
        overlap = np.bitwise_count(bits[1:] & bits[:-1]).sum(axis=1, dtype=np.int64) + np.minimum(lost[1:], lost[:-1])
        near = (100 * n[:-1] >= percent * n[1:]) & (own[1:] != own[:-1])
        near &= (100 + percent) * np.minimum(overlap, n[:-1]) >= percent * (n[1:] + n[:-1])
        found[rows[1:][near]] = found[rows[:-1][near]] = True
        a, b = walk(tree, lambda: [np.where(found[rows], 0, -1), own], percent)
        apart = own[a] != own[b]
        found[rows[a[apart]]] = found[rows[b[apart]]] = True
    return found


def links(sets: list[np.ndarray], labels: list, sides: np.ndarray | None = None,
          percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what ``labels`` (components so far) leave apart; with ``sides``, only between sides.

    Not every link: those inside a component would change nothing. Places in ``sets`` are returned.
    """
    if len(sets) < 2:
        return []
    sizes = np.array([len(x) for x in sets])
    bits = bits_for(int(sizes.max()))
    tree = Tree(np.stack([signature(x, bits) for x in sets]), sizes, np.array([x[0] for x in sets]))
    forest, found = Forest(labels), []
    order = tree.order

    def compare(i: int, j: int) -> None:
        a, b = sets[i], sets[j]
        if len(a) > len(b):
            a, b = b, a
        if 100 * len(a) < percent * len(b):
            return
        at = np.searchsorted(b, a)
        both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        if 100 * both >= percent * (len(a) + len(b) - both) and forest.join(i, j):
            found.append((i, j))

    # neighbours first: near copies are mostly side by side, and connected subtrees are then cut off whole
    for i, j in zip(order[:-1].tolist(), order[1:].tolist()):
        if (sides is None or sides[i] != sides[j]) and forest.root(i) != forest.root(j):
            compare(i, j)
    a, b = walk(tree, lambda: [forest.roots()[order]], percent)
    for lo in range(0, len(a), 1 << 14):
        i, j = order[a[lo:lo + (1 << 14)]], order[b[lo:lo + (1 << 14)]]
        roots = forest.roots()
        apart = roots[i] != roots[j]
        if sides is not None:
            apart &= sides[i] != sides[j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist()):
            if forest.root(x) != forest.root(y):
                compare(x, y)
    return found


def _allow_block(percent: int, names: tuple[str, ...]):
    """Rows of a block, by ``names``, whose signature allows a link to another component."""

    def run(rows: pa.Table) -> pa.Table:
        go = partners(rows.column("signature").to_pylist(), rows.column("n").to_numpy(), rows.column("s").to_numpy(),
                      rows.column("comp").to_numpy(), percent)
        return rows.select(list(names)).filter(pa.array(go))

    return run


def _join_block(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        names = rows.column("s").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("members").to_pylist()]
        side = rows.column("side").to_numpy()
        across = len(np.unique(side)) > 1
        pairs = links(sets, rows.column("comp").to_pylist(), side if across else None, percent)
        return pa.table({"a": pa.array([names[i] for i, _ in pairs], pa.int64()),
                         "b": pa.array([names[j] for _, j in pairs], pa.int64())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """``s, comp``: every node of the edges ``a, b`` and the smallest node it is connected to.

    Edges are turned towards smaller nodes until all of them lead to a component's smallest node. Each step reads
    and writes a table; nothing but two numbers reaches the driver.
    """
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        code = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(code) == seen:
            break
        seen = tuple(code)
    roots = now.select(F.col("b").alias("s"), F.col("b").alias("comp")).distinct()
    return now.select(F.col("a").alias("s"), F.col("b").alias("comp")).unionByName(roots)


def join(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, part: int = PART, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    text = F.col(text_column).cast("string")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    load = spark.sparkContext.broadcast(loads(texts.select("text"), width))
    found = written(texts.mapInArrow(_documents(load, width, percent), _DOC), "documents")
    collide = F.raise_error(F.lit("two sets have the same 64-bit name"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t"))  # a null id stands for a set only alone
    nodes = found.filter("n > 0").groupBy("s").agg(
        F.when(F.min("s2") == F.max("s2"), least).otherwise(collide).alias("least"),
        F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("signature").alias("signature"))
    keys = written(nodes.select("s", "least.doc_id", "least.t", "n", "keys", "signature").withColumnRenamed("doc_id", "rep"),
                   "nodes")
    rows = keys.select("s", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    rows = written(rows.join(shared, "key"), "shared")
    same = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("s")).alias("x1"),
                                   F.bit_xor(F.xxhash64(F.lit(3), "s")).alias("x2"))
    blocks = same.groupBy("c", "x1", "x2").agg(F.min("key").alias("key")).select("key", "c")
    members = written(rows.join(blocks, "key"), "members")
    # nodes that signatures allow a link; blocks too large for one tree keep all of theirs
    small = members.filter(F.col("c") <= part)
    by_size = Window.partitionBy("key").orderBy("n")
    near = (100 * F.lag("n").over(by_size) >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.lead("n").over(by_size))
    small = small.withColumn("near", near).filter("near").select("key", "s")
    signed = keys.select("s", "n", "signature")
    allowed = small.withColumn("comp", F.col("s")).join(signed, "s").groupBy("key").applyInArrow(
        _allow_block(percent, ("s", "key")), "s long, key long")
    members = allowed.unionByName(members.filter(F.col("c") > part).select("s", "key"))
    members = written(members, "members")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    members = members.join(sizes, "key")
    # the sets of nodes that share a block, from the text of one document of each
    asked = keys.join(members.select("s").distinct(), "s").select("rep", F.col("t").alias("named"), "s")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                names, own = [], []
                for name, text in zip(some.column(0).to_pylist(), bytes_of(some.column(1))):
                    own_set = shingles(text, width).tobytes()
                    low = xxh3_128_intdigest(own_set) & (1 << 64) - 1
                    if low - (low >> 63 << 64) == name:  # another text may have the same hash
                        names.append(name)
                        own.append(own_set)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(own, pa.binary())],
                                                 ["s", "members"])

    same = (F.col("t") == F.col("named")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    wanted = texts.join(asked, same).select("s", "text")
    sets_of = written(wanted.mapInArrow(sets, "s long, members binary").dropDuplicates(["s"]), "sets")
    # round one: every node in its largest block, large blocks in parts
    best = members.groupBy("s").agg(F.max(F.struct("c", "key")).alias("b")).select("s", "b.c", "b.key")
    parts = lambda c: F.ceil(c / F.lit(float(part))).cast("int")
    own_part = F.pmod(F.xxhash64("s"), parts(F.col("c"))).cast("int")
    first = best.select("s", "key", own_part.alias("i"), F.lit(0).alias("side"), F.col("s").alias("comp"))
    first = first.join(sets_of, "s").groupBy("key", "i").applyInArrow(_join_block(percent), "a long, b long")
    first = written(first, "links")
    so_far = components(first)
    # round two: blocks that still hold several components, every pair of parts
    known = members.join(so_far, "s", "left").select("key", "c", "s", F.coalesce("comp", "s").alias("comp"))
    known = written(known, "known")
    open_keys = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    rest = known.join(open_keys, "key").withColumn("side", own_part).withColumn("parts", parts(F.col("c")))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = rest.select("s", "key", "comp", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    rest = rest.join(signed, "s").groupBy("key", "i", "j").applyInArrow(
        _allow_block(percent, ("s", "key", "comp", "side", "i", "j")), "s long, key long, comp long, side int, i int, j int")
    rest = written(rest, "rest")
    second = rest.join(sets_of, "s").groupBy("key", "i", "j").applyInArrow(_join_block(percent), "a long, b long")
    final = components(written(first.unionByName(second), "links"))
    named = keys.select("s", "rep").join(final, "s", "left").withColumn("comp", F.coalesce("comp", "s"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "comp").select("s", "component_id")
    return found.join(named, "s", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component: the smallest id. Rows without shingles stay.

    Of rows that repeat both id and text one stays. Different texts under one id, null included, are kept when one of
    them stands for its component.
    """
    found = written(join(docs, percent, width, id_column=id_column, text_column=text_column), "components")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) | (F.col("n_shingles") == 0)
    name = fresh(docs, "first_id")
    firsts = found.filter(first).select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(firsts, F.col(id_column).cast("long").eqNullSafe(F.col(name)), "left_semi")
    if found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").limit(1).count():
        kept = kept.dropDuplicates([id_column, text_column])  # rows that repeat an id and its text
    return kept


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a Jaccard similarity of 0.85 on 4-word shingles."""
    return join(table(spark, sf_dir, "documents"))


QUERIES = {"op6_ngram_jaccard_join": op6_ngram_jaccard_join}
SQL: dict[str, str] = {}
