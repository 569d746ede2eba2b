"""Nearest neighbours by cosine: low-dimensional stable projections, a kd-tree, and a chi-square stopping test.

Vectors are scaled to length one, where the nearest by distance is the nearest by cosine, and projected to ``M``
dimensions by Gaussian (2-stable) weights: the squared projected distance over the squared distance follows a
chi-square distribution with ``M`` degrees of freedom. A query looks at vectors by growing projected distance and
verifies each; it may stop at projected distance ``r`` once a vector closer than its ``k``-th best so far would have
been met with probability ``CONFIDENCE``, that is once ``r^2 / d_k^2`` reaches that quantile.

The kd-tree has two parts. Its top is built on a bounded sample (``SAMPLE`` projected vectors) and cuts the space
into cells of about ``CELL_ROWS`` rows; every vector is indexed in its cell, where the tree goes on. A query first
searches its own cell, which gives ``d_k`` and so the radius at which the test must hold, and then every other cell
that the radius reaches.

Equal vectors are indexed once, with their ``k + 1`` smallest ids, so a vector that very many rows share is one point.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no part, neither as
queries nor as candidates; vectors of different lengths are not compared; equal scores go by the smaller id; a query
with fewer candidates gets them all; ids that are null take no part, and rows that repeat an id count once for each
different vector as candidates, while the query of that id is the smallest of its vectors; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, written

M = 8  # projected dimensions; even, so that the chi-square distribution has a closed form
CONFIDENCE = 0.98
SAMPLE = 20_000
CELL_ROWS = 4000
LEAF = 512
K = 5
SEED = 5

_HITS = "query_id long, vec_id long, score double"


def chi_square(x: float, m: int = M) -> float:
    """Distribution function with an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, m // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def quantile(p: float, m: int = M) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, m) < p else (lo, mid)
    return hi


def projection(dimensions: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dimensions]).standard_normal((dimensions, M))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / largest  # neither tiny nor huge components leave the range of doubles
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosine(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines in double precision on the original vectors."""
    q, o = query.astype(np.float64), others.astype(np.float64)
    return (o * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((o * o).sum(axis=1)))


# ---------------------------------------------------------------- kd-trees


class Tree:
    """Median splits on the widest dimension; nodes in arrays, children of ``i`` in ``left[i]`` and ``right[i]``."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.left, self.right, self.axis, self.cut, self.span = [], [], [], [], []
        self.low, self.high = [], []
        self._build(points, 0, len(points), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, points: np.ndarray, lo: int, hi: int, leaf: int) -> int:
        own = points[self.order[lo:hi]]
        node = len(self.left)
        small, large = own.min(axis=0), own.max(axis=0)
        for column, value in ((self.left, -1), (self.right, -1), (self.axis, -1), (self.cut, 0.0), (self.span, (lo, hi)),
                              (self.low, small), (self.high, large)):
            column.append(value)
        axis = int(np.argmax(large - small))
        if hi - lo > leaf and large[axis] > small[axis]:
            values = own[:, axis]
            cut = float(np.median(values))
            if cut == large[axis]:  # more than half at the top: they go right
                cut = float(values[values < cut].max())
            goes_left = values <= cut
            part = self.order[lo:hi]
            self.order[lo:hi] = np.concatenate([part[goes_left], part[~goes_left]])
            mid = lo + int(goes_left.sum())
            self.axis[node], self.cut[node] = axis, cut
            self.left[node] = self._build(points, lo, mid, leaf)
            self.right[node] = self._build(points, mid, hi, leaf)
        return node

    def nearest_first(self, point: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Leaves by growing squared distance of their boxes, each as a range of ``order``."""
        heap = [(0.0, 0)]
        while heap:
            distance, node = heapq.heappop(heap)
            if self.left[node] < 0:
                yield distance, *self.span[node]
                continue
            for child in (self.left[node], self.right[node]):
                gap = np.maximum(0.0, np.maximum(self.low[child] - point, point - self.high[child]))
                heapq.heappush(heap, (float(gap @ gap), child))


class Cells:
    """The top of the tree. Its cells cover the whole space: a point outside the sample falls on one side of each cut."""

    def __init__(self, sample: np.ndarray, rows: int, cell_rows: int):
        leaf = max(1, math.ceil(len(sample) * cell_rows / max(rows, 1)))
        self.axis, self.cut, self.left, self.right = [], [], [], []
        self.low, self.high, self.cell = [], [], []
        self.count = 0
        if len(sample):
            tree = Tree(sample, leaf)
            self._copy(tree, 0, np.full(M, -np.inf), np.full(M, np.inf))
        else:
            self._add(-1, 0.0, np.full(M, -np.inf), np.full(M, np.inf))

    def _add(self, axis: int, cut: float, low: np.ndarray, high: np.ndarray) -> int:
        node = len(self.axis)
        self.axis.append(axis)
        self.cut.append(cut)
        self.left.append(-1)
        self.right.append(-1)
        self.low.append(low)
        self.high.append(high)
        self.cell.append(-1)
        if axis < 0:
            self.cell[node] = self.count
            self.count += 1
        return node

    def _copy(self, tree: Tree, at: int, low: np.ndarray, high: np.ndarray) -> int:
        node = self._add(tree.axis[at], tree.cut[at], low, high)
        axis = tree.axis[at]
        if axis >= 0:
            left_high, right_low = high.copy(), low.copy()
            left_high[axis] = right_low[axis] = tree.cut[at]
            self.left[node] = self._copy(tree, tree.left[at], low, left_high)
            self.right[node] = self._copy(tree, tree.right[at], right_low, high)
        return node

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.axis[node] < 0:
                out[rows] = self.cell[node]
                continue
            goes_left = points[rows, self.axis[node]] <= self.cut[node]
            todo += [(self.left[node], rows[goes_left]), (self.right[node], rows[~goes_left])]
        return out

    def reached(self, point: np.ndarray, radius: float) -> list[int]:
        out, todo = [], [0]
        while todo:
            node = todo.pop()
            gap = np.maximum(0.0, np.maximum(self.low[node] - point, point - self.high[node]))
            if float(gap @ gap) > radius * radius:
                continue
            if self.axis[node] < 0:
                out.append(self.cell[node])
            else:
                todo += [self.left[node], self.right[node]]
        return out


class Cell:
    """The vectors of one cell under their kd-tree, in its order."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        unit = _unit(vectors)
        projected = unit @ projection(vectors.shape[1])
        self.tree = Tree(projected, LEAF)
        order = self.tree.order
        self.vectors, self.unit, self.projected = vectors[order], unit[order], projected[order]
        self.ids = [ids[i] for i in order]
        self.copies = np.array([len(i) for i in self.ids])

    def search(self, query: np.ndarray, own: int, k: int, limit: float, best: list[float]) -> list[tuple[float, int]]:
        """Hits of one query.

        Leaves come by growing projected distance; what is left is not looked at once the test holds for the ``k``-th
        best distance so far (``best`` are cosines known from elsewhere). Vectors are verified on the unit vectors;
        those that may be among the best are scored exactly, on the original ones.
        """
        unit = _unit(query[None])[0]
        point = unit @ projection(len(query))
        top = sorted(best, reverse=True)[:k]
        rows: list[int] = []
        scores: list[float] = []
        for distance, lo, hi in self.tree.nearest_first(point):
            reach = limit * max(0.0, 2 - 2 * top[-1]) + 1e-9 if len(top) == k else math.inf  # squared
            if distance > reach:
                break
            gaps = self.projected[lo:hi] - point
            near = np.einsum("ij,ij->i", gaps, gaps) <= reach
            found = self.unit[lo:hi] @ unit
            if len(top) == k:
                near &= found >= top[-1] - 1e-9
            at = np.flatnonzero(near)
            if not len(at):
                continue
            rows += (at + lo).tolist()
            scores += found[at].tolist()
            # the query itself is among them perhaps: one of its copies does not count
            counted = [s for r, s in zip((at + lo).tolist(), found[at].tolist())
                       for _ in range(self.copies[r] - (own in self.ids[r]))]
            top = sorted(top + counted, reverse=True)[:k]
        floor = top[-1] - 1e-9 if len(top) == k else -math.inf
        rows = [r for r, s in zip(rows, scores) if s >= floor]
        exact = cosine(query, self.vectors[rows]).tolist() if rows else []
        hits = [(s, i) for r, s in zip(rows, exact) for i in self.ids[r] if i != own]
        return sorted(hits, key=lambda h: (-h[0], h[1]))[:k]


# ---------------------------------------------------------------- Spark


def valid(vector: Column) -> Column:
    """Vectors that take part."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, good) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """``vector, ids``: every different vector once with its ``k + 1`` smallest ids, in two steps so that a vector that
    many rows share is dealt over many tasks first."""
    from pyspark.sql import Window

    name = [F.xxhash64("vector"), F.xxhash64(F.lit(9), "vector")]
    keyed = vectors.select("vec_id", "vector", name[0].alias("n1"), name[1].alias("n2"))
    keyed = keyed.dropDuplicates(["n1", "n2", "vec_id"])
    some = Window.partitionBy("n1", "n2", F.pmod(F.xxhash64("vec_id"), F.lit(256))).orderBy("vec_id")
    fewer = keyed.withColumn("r", F.row_number().over(some)).filter(F.col("r") <= k + 1).drop("r")
    every = Window.partitionBy("n1", "n2").orderBy("vec_id")
    least = fewer.withColumn("r", F.row_number().over(every)).filter(F.col("r") <= k + 1)
    return least.groupBy("n1", "n2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _placed(cells: dict, column: str, out: str):
    """Adds the home cell of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                vectors, home = part.column(part.schema.get_field_index(column)), np.zeros(part.num_rows, np.int32)
                sizes = np.diff(vectors.offsets.to_numpy())
                for d in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == d)
                    points = _unit(_matrix(vectors.take(pa.array(rows)))) @ projection(d)
                    home[rows] = cells[d].home(points)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes.astype(np.int32)), pa.array(home)],
                                                 [*part.schema.names, "d", "cell"])

    return run


def _search_cell(k: int, limit: float, wider: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Queries of a cell (left) against its vectors (right)."""
        out: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            cell = Cell(_matrix(right.column("vector").combine_chunks()), right.column("ids").to_pylist())
            queries = _matrix(left.column("vector").combine_chunks())
            known = left.column("best").to_pylist() if wider else [[]] * len(queries)
            for own, query, best in zip(left.column("vec_id").to_pylist(), queries, known):
                out += [(own, i, s) for s, i in cell.search(query, own, k, limit, best)]
        columns = list(zip(*out)) or [()] * 3
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    return run


def _top(hits: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.distinct().withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: Column, k: int = K, confidence: float = CONFIDENCE, sample: int = SAMPLE,
            cell_rows: int = CELL_ROWS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows that ``queries`` names, against all rows."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & valid(F.col("vector")))
    points = written(distinct_vectors(rows, k), "points")
    sizes = {r["d"]: r["c"] for r in points.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("c")).collect()}
    total = sum(sizes.values())
    share = min(1.0, sample / max(total, 1))
    chosen = points.filter(F.pmod("n1", F.lit(1_000_000)) < math.ceil(share * 1_000_000)).select("vector")
    by_size: dict[int, list] = {d: [] for d in sizes}
    for r in chosen.collect():  # about `sample` vectors
        by_size[len(r["vector"])].append(r["vector"])
    cells = {}
    for d, own in by_size.items():
        projected = _unit(np.array(own)) @ projection(d) if own else np.empty((0, M))
        cells[d] = Cells(projected, sizes[d], cell_rows)
    element = points.schema["vector"].dataType.simpleString()
    put = lambda df, more: df.mapInArrow(_placed(cells, "vector", "cell"), f"{more}, d int, cell int")
    indexed = written(put(points.select("vector", "ids"), f"vector {element}, ids array<long>"), "index")
    asked = written(put(rows.filter(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")),
                        f"vec_id long, vector {element}"), "queries")
    limit = quantile(confidence)
    home = asked.groupBy("d", "cell").cogroup(indexed.groupBy("d", "cell")).applyInArrow(_search_cell(k, limit, False), _HITS)
    home = written(home, "home")
    best = home.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("best"))  # k a query
    known = asked.join(best, asked["vec_id"] == best["query_id"], "left").select(
        "vec_id", "vector", "d", F.col("cell").alias("own"), F.coalesce("best", F.array().cast("array<double>")).alias("best"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                at, to = [], []
                for i, (vector, d, own, known_best) in enumerate(zip(*[part.column(c).to_pylist() for c in (1, 2, 3, 4)])):
                    point = (_unit(np.array([vector])) @ projection(d))[0]
                    radius = math.sqrt(limit * max(0.0, 2 - 2 * known_best[k - 1]) + 1e-9) if len(known_best) >= k else math.inf
                    for cell in cells[d].reached(point, radius):
                        if cell != own:
                            at.append(i)
                            to.append(cell)
                some = part.take(pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in (0, 1, 2, 4)], pa.array(to, pa.int32())],
                                                 ["vec_id", "vector", "d", "best", "cell"])

    wide = known.mapInArrow(spread, f"vec_id long, vector {element}, d int, best array<double>, cell int")
    more = wide.groupBy("d", "cell").cogroup(indexed.groupBy("d", "cell")).applyInArrow(_search_cell(k, limit, True), _HITS)
    found = _top(home.unionByName(more), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every row whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op10_nearest_neighbours": op10_nearest_neighbours}
SQL: dict[str, str] = {}  # a query may miss a neighbour with a chance of 1 - CONFIDENCE
