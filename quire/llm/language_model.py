"""Scores of whole documents by a gated recurrent language model.

*Counts.* Words are counted over all training documents; they give the unigram base and the model's vocabulary: the
most frequent words, one end sign, and ``GROUPS`` groups of the rarer words by a hash of their last two characters.
A rarer word is its group (from the network) times its share of the group (from the counts, with the same smoothing
as the base), so every text has a probability and probabilities sum to one.

*Network.* One gated recurrent layer with a reset and an update gate. Its softmax is factored: first a class of ``CLASS`` entries of neighbouring
frequency, then the entry within the class. Training is truncated backpropagation through ``STEPS`` tokens in numpy;
documents follow each other in ``LANES`` lanes, and a lane's state is carried from window to window and cleared where
a document begins. Scoring carries the state through the whole document.

*Distribution.* Training documents are dealt over shards of bounded size; in each round every shard takes its steps
from the same start, and the next start is the mean of the shards' parameters weighted by tokens. Every training
document is used in exactly one round. Shuffled parameters are one set a shard, combined before the shuffle.

Words too rare to be known everywhere are joined with their counts on the word: nothing that grows with the
vocabulary is broadcast.

Defined cases: a null text is empty and has the end sign alone; repeated rows get equal scores, and rows with a null
id are held out; with no training document the base has ``N = V = 0`` and the network stays at its start; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, written

HIDDEN = 24
CLASS = 32
ENTRIES = 1024  # vocabulary of the network: frequent words, the end sign and the groups
GROUPS = 96
COMMON = 100_000  # words whose counts every worker holds; rarer ones are joined
LANES = 128
STEPS = 20
PIECE = 400  # tokens; training cuts longer documents, so that lanes stay full. Scoring cuts none
ROUNDS = 3
RATE = 0.1
INIT = 1e-5  # start of the sums of squared gradients
SHARD_TOKENS = 4_000_000  # tokens of a shard in one round
SCORED_TOKENS = 6_000_000  # in lanes side by side; a limit on memory only
BLOCK = 8 << 20  # bytes of texts split into words together, or one text; a limit on memory only
END = b""  # no word is empty
ALPHA = 0.1

SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def held_out(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def blocks_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``BLOCK`` bytes of text."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    blocks = np.cumsum(sizes, dtype=np.int64) // BLOCK
    edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), batch.num_rows]
    return (batch.slice(lo, hi - lo) for lo, hi in zip(edges, edges[1:]))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Tokens of a column of texts: their numbers in a list of the different words, that list, the tokens of each text.

    Arrow's ``ascii`` functions lower A-Z alone and split at space and U+0009 to U+000D alone, as asked. A text that ends
    in a blank gives its words and one empty word, which is the end sign; so does the empty text.
    """
    texts = pc.ascii_ltrim_whitespace(pc.ascii_lower(texts.fill_null("")))
    blank = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ")
    lists = pc.ascii_split_whitespace(pc.binary_join_element_wise(texts, blank, ""))
    words = lists.flatten().dictionary_encode()
    return words.indices.to_numpy(), words.dictionary.cast(pa.binary()), np.diff(lists.offsets.to_numpy())


def group_of(word: bytes) -> int:
    """Group of a rare word. The last two characters tell much about its language and form."""
    return zlib.crc32(word[-2:] if word.isascii() else word.decode(errors="replace")[-2:].encode()) % GROUPS


# ---------------------------------------------------------------- counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def rows() -> list[pa.RecordBatch]:
        seen = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
        held.clear()
        return seen.select(["word", "c_sum"]).rename_columns(["word", "c"]).to_batches()

    for batch in batches:
        for part in blocks_of(batch, 1):
            learned = pa.array([not held_out(k) for k in part.column(0).to_pylist()], pa.bool_())
            numbers, words, _ = tokens_of(part.column(1).filter(learned))
            held.append(pa.table({"word": words, "c": np.bincount(numbers, minlength=len(words))}))
            if sum(t.num_rows for t in held) > 500_000:
                yield from rows()
    if held:
        yield from rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over all training documents; the end sign is the empty word."""
    return docs.mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """What every worker knows of the counts: totals, the common words, the network's entries, the groups' totals."""

    def __init__(self, total: int, distinct: int, common: list[tuple[bytes, int]], groups: dict[int, tuple[int, int]]):
        self.total, self.distinct = total, distinct
        self.floor = total + ALPHA * (distinct + 1)
        count = dict(common)
        listed = [w for w, _ in common if w != END][:ENTRIES - GROUPS - 1]
        self.listed = {END: 0} | {w: i + 1 for i, w in enumerate(listed)}
        mass = np.full(ENTRIES, 0.5)
        mass[0] = max(count.get(END, 0), 0.5)
        for w, i in self.listed.items():
            mass[i] = max(mass[i], count.get(w, 0))
        self.group_floor = np.zeros(GROUPS)
        for g in range(GROUPS):
            c, v = groups.get(g, (0, 0))
            mass[len(self.listed) + g] = max(c, 0.5)
            self.group_floor[g] = np.log10(c + ALPHA * (v + 1))
        self.first_group = len(self.listed)
        # classes of neighbouring frequency: an entry's number is its rank
        rank = np.empty(ENTRIES, np.int64)
        rank[np.argsort(-mass, kind="stable")] = np.arange(ENTRIES)
        self.rank, self.mass = rank, np.sort(mass)[::-1].copy()
        # of each common word: its number, and by that its entry, base score and share of its group
        self.number = {w: i for i, w in enumerate(count)}
        own = np.log10(np.fromiter(count.values(), np.float64, len(count)) + ALPHA)
        group = np.array([-1 if w in self.listed else group_of(w) for w in count], np.int64)
        place = [self.listed.get(w, self.first_group + g) for w, g in zip(count, group.tolist())]
        self.entries = rank[np.array(place, np.int64)].astype(np.int16)
        self.base, self.share = own - np.log10(self.floor), np.where(group < 0, 0.0, own - self.group_floor[group])

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: entry, base score, share of its group, and the group of one that has to be joined (-2: none; -1:
        no group, as the network lists it), which has no scores yet."""
        number = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        rare = np.flatnonzero(number < 0)
        joined = np.full(len(words), -2, np.int32)
        if len(self.number):
            entry, base, share = (t.take(number, mode="clip") for t in (self.entries, self.base, self.share))
        else:
            entry, base, share = np.zeros(len(words), np.int16), np.zeros(len(words)), np.zeros(len(words))
        base[rare] = share[rare] = 0.0
        for i in rare.tolist():
            at = self.listed.get(words[i])
            joined[i] = g = -1 if at is not None else group_of(words[i])
            entry[i] = self.rank[self.first_group + g if at is None else at]
        return entry, base, share, joined


def least_common(counts: DataFrame, most: int) -> int:
    """The smallest count such that at most ``most`` words have it or more.

    Two small tables reach the driver: words by the logarithm of their count (64 steps a factor of two), and words by
    count within the step in which the number is reached. Words that tie are all in or all out.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 64)
    held, least = 0, None
    for r in counts.groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("k")).collect():
        if held + r["n"] > most:
            least = r["k"]
            break
        held += r["n"]
    if least is None:
        return 0
    above = None
    for r in counts.filter(step == least).groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect():
        if held + r["n"] > most:
            return r["c"] + 1 if above is None else above
        held, above = held + r["n"], r["c"]
    return above


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the stored counts. The driver gets at most ``COMMON`` words, a short histogram and one row a group."""
    total = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    common = counts.filter(F.col("c") >= least_common(counts, COMMON)).collect()
    common.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    listed = {END} | {w for w in [bytes(r["word"]) for r in common if bytes(r["word"]) != END][:ENTRIES - GROUPS - 1]}

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, v = np.zeros(GROUPS, np.int64), np.zeros(GROUPS, np.int64)
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word not in listed:
                    g = group_of(word)
                    c[g] += n
                    v[g] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(GROUPS)), pa.array(c), pa.array(v)], ["g", "c", "v"])

    groups = counts.mapInArrow(rare, "g long, c long, v long").groupBy("g").agg(F.sum("c").alias("c"), F.sum("v").alias("v"))
    return Vocabulary(total[0] or 0, total[1], [(bytes(r["word"]), r["c"]) for r in common],
                      {r["g"]: (r["c"], r["v"]) for r in groups.collect()})


# ---------------------------------------------------------------- network


class Network:
    """Parameters by name; ``flat`` and ``load`` turn them into one vector and back."""

    def __init__(self, mass: np.ndarray):
        rng = np.random.default_rng(11)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        classes = ENTRIES // CLASS
        by_class = mass.reshape(classes, CLASS)
        start = np.log(by_class / by_class.sum(axis=1, keepdims=True))
        self.p = {
            # input of each entry to gates and content; the last two are a document's start and the start of a later piece
            "x": draw(ENTRIES + 2, 3 * HIDDEN),
            "f": draw(HIDDEN, 2 * HIDDEN) * 2, "n": draw(HIDDEN, HIDDEN) * 2, "nb": np.zeros(HIDDEN, np.float32),
            "c": draw(HIDDEN, classes), "cb": np.log(by_class.sum(axis=1) / mass.sum()).astype(np.float32),
            "w": draw(classes, HIDDEN, CLASS), "wb": start.astype(np.float32),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size


def _recurrent(p: dict) -> np.ndarray:
    """The state's weights to the two gates and the content, one matrix each, so that each of the three has its own block."""
    gates = p["f"].reshape(HIDDEN, 2, HIDDEN).transpose(1, 0, 2)
    return np.concatenate([gates, p["n"][None]]).astype(np.float32)


def forward(p: dict, inputs: np.ndarray, starts: np.ndarray, state: np.ndarray, live: np.ndarray | None = None):
    """Hidden states before each target. ``inputs``: steps by lanes; ``starts``: lanes whose document begins there.
    ``live``: lanes still running at each step (lanes are sorted so that the first run longest).

    The unit: gates ``r, z = sigmoid(x_f + h F)``, content ``n = tanh(x_n + r (h N + b))``, state ``n + z (h - n)``.
    Without ``live``, what the gradients need is kept: states, gates with ``h N + b``, and contents of all steps.
    """
    steps, lanes = inputs.shape
    xs, bias = p["x"].reshape(-1, HIDDEN), np.tile(p["nb"].astype(np.float32), (lanes, 1))
    weights = _recurrent(p)
    weights[:2] *= -1  # a sigmoid needs the exponential of the negative
    places = inputs[:, None].astype(np.intp) * 3 + np.arange(3)[:, None]  # an entry's input is three rows, as the weights
    out = np.zeros((steps, lanes, HIDDEN), np.float32)
    kept = [np.empty((steps, *shape, lanes, HIDDEN), np.float32) for shape in ((), (3,), ())] if live is None else None
    fresh, going = starts.any(axis=1), ~starts[:, :, None]
    for t in range(steps):
        n = lanes if live is None else int(live[t])
        h = state[:n]
        if fresh[t]:
            h = h * going[t, :n]
        if kept:
            kept[0][t], pre, new = h, kept[1][t], kept[2][t]
        else:
            pre, new = np.empty((3, n, HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32)
        x = xs.take(places[t, :, :n], axis=0)
        np.matmul(h, weights, out=pre)
        gates, inner = pre[:2], pre[2]
        gates -= x[:2]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        inner += bias[:n]
        np.multiply(gates[0], inner, out=new)
        new += x[2]
        np.tanh(new, out=new)
        state = out[t, :n]
        np.subtract(h, new, out=state)
        state *= gates[1]
        state += new
    return out, kept


def _sorted_by_class(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the targets by class, and each class with its first and last place in that order."""
    classes = (targets // CLASS).astype(np.int16)
    order = np.argsort(classes, kind="stable")
    edges = np.searchsorted(classes[order], np.arange(ENTRIES // CLASS + 1)).tolist()
    return order, [(c, lo, hi) for c, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]


def _normalised(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of scores and their sums. Scores are small: biases are log-probabilities and states below one."""
    np.minimum(scores, 60, out=scores)
    scores = np.exp(scores, out=scores)
    return scores, scores @ np.ones(scores.shape[1], scores.dtype)


def _and_one(hidden: np.ndarray) -> np.ndarray:
    """A column of ones at the end, to which biases belong."""
    out = np.empty((len(hidden), HIDDEN + 1), np.float32)
    out[:, :HIDDEN], out[:, HIDDEN] = hidden, 1
    return out


def _output(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes and, by class, of its entries, with the biases as their last row."""
    return (np.concatenate([p["c"], p["cb"][None]]).astype(np.float32),
            np.concatenate([p["w"], p["wb"][:, None]], axis=1).astype(np.float32))


def _within(weights: np.ndarray, hidden: np.ndarray, classes: list) -> tuple[np.ndarray, np.ndarray]:
    """``_normalised`` scores of the entries of each target's class; rows are sorted by class."""
    inner = np.empty((len(hidden), CLASS), np.float32)
    for c, lo, hi in classes:
        np.matmul(hidden[lo:hi], weights[c], out=inner[lo:hi])
    return _normalised(inner)


def log_probabilities(p: dict, hidden: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target entry."""
    order, classes = _sorted_by_class(targets)
    hidden, wanted = _and_one(hidden.take(order, axis=0)), targets.take(order)
    by_class, by_entry = _output(p)
    scores, sums = _normalised(hidden @ by_class)
    inner, inner_sums = _within(by_entry, hidden, classes)
    rows = np.arange(0, len(targets) * CLASS, CLASS)
    found = inner.ravel().take(rows + wanted % CLASS)
    found *= scores.ravel().take(np.arange(len(targets)) * scores.shape[1] + wanted // CLASS)
    out = np.empty(len(targets), np.float32)
    out[order] = np.log(found) - np.log(sums) - np.log(inner_sums)
    return out


def _sums_by(ids: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, and the sums over the rows of each in every block (blocks by rows by columns)."""
    by_id = np.argsort(ids, kind="stable")
    ids = ids[by_id]
    first = np.flatnonzero(np.diff(ids, prepend=-1))
    count = np.diff(first, append=len(ids))
    sums = blocks.take(by_id[first], axis=1)
    again = np.flatnonzero(count > 1)
    if len(again):
        rows, count = by_id[np.repeat(count > 1, count)], count[again]
        pairs = blocks.take(rows, axis=1).view(np.complex64)  # two columns as one number: numpy adds half as often
        sums[:, again] = np.add.reduceat(pairs, np.cumsum(count) - count, axis=1).view(np.float32)
    return ids[first], sums


def _gradients(p: dict, inputs, targets, starts, mask, state):
    """Gradients of the mean log-loss over one window, and the state at its end."""
    out, (held, pre, new) = forward(p, inputs, starts, state)
    r, z, inner = pre[:, 0], pre[:, 1], pre[:, 2]
    steps, lanes = inputs.shape
    flat_mask = np.flatnonzero(mask.ravel())
    wanted = targets.ravel()[flat_mask]
    order, classes = _sorted_by_class(wanted)
    place = flat_mask[order]
    hidden, wanted = _and_one(out.reshape(-1, HIDDEN).take(place, axis=0)), wanted[order]
    n = max(1, len(wanted))
    by_class, by_entry = _output(p)
    rows = np.arange(len(wanted))
    scores, sums = _normalised(hidden @ by_class)
    scores *= np.reciprocal(sums)[:, None]
    scores[rows, wanted // CLASS] -= 1
    d_class = hidden.T @ scores
    back = scores @ by_class[:HIDDEN].T
    scores, sums = _within(by_entry, hidden, classes)
    scores *= np.reciprocal(sums)[:, None]
    scores[rows, wanted % CLASS] -= 1
    d_entry = np.zeros_like(by_entry)
    within = np.empty_like(back)
    for c, lo, hi in classes:
        own = scores[lo:hi]
        np.matmul(hidden[lo:hi].T, own, out=d_entry[c])
        np.matmul(own, by_entry[c, :HIDDEN].T, out=within[lo:hi])
    back += within
    d_out = np.zeros((steps * lanes, HIDDEN), np.float32)
    d_out[place] = back
    d_out = d_out.reshape(steps, lanes, HIDDEN)
    # what does not depend on later steps: slopes of the content and the gates
    both = 1 - pre[:, :2]
    by_content = new * new
    np.subtract(1, by_content, out=by_content)
    by_content *= both[:, 1]
    both *= pre[:, :2]
    by_reset, by_update = both[:, 0], both[:, 1]
    by_reset *= inner
    by_update *= held - new
    d_pre = np.empty((4, steps, lanes, HIDDEN), np.float32)  # of the content, the gates, and h N
    d_h = np.zeros((lanes, HIDDEN), np.float32)
    weights = np.ascontiguousarray(_recurrent(p).transpose(0, 2, 1))
    fresh, going = starts.any(axis=1), ~starts[:, :, None]
    for t in range(steps - 1, -1, -1):
        d = d_out[t]
        d += d_h
        d_n = np.multiply(d, by_content[t], out=d_pre[0, t])
        np.multiply(d_n, by_reset[t], out=d_pre[1, t])
        np.multiply(d, by_update[t], out=d_pre[2, t])
        np.multiply(d_n, r[t], out=d_pre[3, t])
        parts = np.matmul(d_pre[1:, t], weights)
        d_h = np.multiply(d, z[t], out=d)
        for part in parts:
            d_h += part
        if fresh[t]:
            d_h *= going[t]
    f1, f2, nn = np.matmul(held.transpose(0, 2, 1), d_pre[1:]).sum(axis=1)
    d_bias = np.ones(steps * lanes, np.float32) @ d_pre[3].reshape(-1, HIDDEN)
    ids, (d_n, d_r, d_z) = _sums_by(inputs.ravel().astype(np.int16), d_pre[:3].reshape(3, -1, HIDDEN))
    grads = {"f": np.concatenate([f1, f2], axis=1), "n": nn, "nb": d_bias, "c": d_class[:HIDDEN], "cb": d_class[HIDDEN],
             "w": d_entry[:, :HIDDEN], "wb": d_entry[:, HIDDEN]}
    return {k: g / n for k, g in grads.items()}, (ids, np.concatenate([d_r, d_z, d_n], axis=1) / n), out[-1].copy()


def lanes_of(docs: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Lay documents end to end in lanes, the longest first into the shortest lane.

    Targets (steps by lanes), whether a document starts there, lengths of the lanes (longest lane first), and the lane
    and step at which each document begins.
    """
    import heapq

    heap = [(0, i) for i in range(min(lanes, max(1, len(docs))))]
    rows: list[list[int]] = [[] for _ in heap]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        length, lane = heapq.heappop(heap)
        rows[lane].append(d)
        heapq.heappush(heap, (length + len(docs[d]), lane))
    mix = np.random.default_rng(3)  # else training would end on short documents only
    rows = [mix.permutation(row).tolist() for row in rows]
    sizes = np.array([sum(len(docs[d]) for d in row) for row in rows])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    targets = np.zeros((int(sizes[0]) if len(docs) else 0, len(rows)), np.int16)
    starts = np.zeros(targets.shape, bool)
    begin: list[tuple[int, int]] = [(0, 0)] * len(docs)
    for place, lane in enumerate(order.tolist()):
        at = 0
        for d in rows[lane]:
            targets[at:at + len(docs[d]), place] = docs[d]
            starts[at, place] = True
            begin[d] = (place, at)
            at += len(docs[d])
    return targets, starts, sizes, begin


def _inputs(targets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The entry before each target; a document's start where one begins."""
    out = np.empty_like(targets)
    out[0] = ENTRIES
    out[1:] = targets[:-1]
    out[starts] = ENTRIES
    return out


def train(net: Network, docs: list[np.ndarray]) -> int:
    """One pass over documents by truncated backpropagation with adaptive steps; tokens seen."""
    pieces = [d[i:i + PIECE] for d in docs for i in range(0, len(d), PIECE)]
    later = [i > 0 for d in docs for i in range(0, len(d), PIECE)]
    targets, starts, sizes, begin = lanes_of(pieces, LANES)
    inputs = _inputs(targets, starts) if len(pieces) else targets
    for (lane, at), middle in zip(begin, later):
        if middle:
            inputs[at, lane] = ENTRIES + 1
    state = np.zeros((targets.shape[1], HIDDEN), np.float32)
    # all parameters but the inputs side by side; ``net.p`` has views of them
    names = [k for k in net.p if k != "x"]
    own = np.concatenate([net.p[k].ravel() for k in names])
    edges = np.cumsum([net.p[k].size for k in names])[:-1]
    net.p |= {k: v.reshape(net.p[k].shape) for k, v in zip(names, np.split(own, edges))}
    squares, x_squares = np.full_like(own, INIT), np.full_like(net.p["x"], INIT)
    for at in range(0, len(targets), STEPS):
        end = min(at + STEPS, len(targets))
        live = int((sizes > at).sum())
        mask = (np.arange(at, end)[:, None] < sizes[:live])
        grads, (ids, rows), last = _gradients(net.p, inputs[at:end, :live], targets[at:end, :live].astype(np.int64),
                                              starts[at:end, :live], mask, state[:live].copy())
        state[:live] = last
        g = np.concatenate([grads[k].ravel() for k in names])
        norm = np.sqrt(float(np.dot(g, g)) + float(np.vdot(rows, rows)))
        cut = min(1.0, 1.0 / max(norm, 1e-9))
        rate = RATE * mask.sum() / (LANES * STEPS)  # windows with few lanes left count for what they hold
        for g, total, values, at_ids in ((g, squares, own, slice(None)), (rows, x_squares, net.p["x"], ids)):
            g *= np.float32(cut)
            sums = total[at_ids]
            sums += g * g
            total[at_ids] = sums
            g *= np.float32(rate)
            g /= np.sqrt(sums)
            values[at_ids] -= g
    return int(sizes.sum())


def score(p: dict, docs: list[np.ndarray], lanes: int = 512) -> np.ndarray:
    """Natural log-probability of each document's entries."""
    if not len(docs):
        return np.zeros(0)
    targets, starts, sizes, begin = lanes_of(docs, lanes)
    inputs = _inputs(targets, starts)
    lane, first = np.array(begin).T
    ends = first + np.array([len(d) for d in docs])
    by_end = np.argsort(ends, kind="stable")
    state = np.zeros((targets.shape[1], HIDDEN), np.float32)
    lane_sums = np.zeros(targets.shape[1])
    sums = np.zeros(len(docs))  # of a document's lane when it ends
    for at in range(0, len(targets), 64):
        end = min(at + 64, len(targets))
        live = np.searchsorted(-sizes, -np.arange(at, end), side="left")
        n = int(live[0])
        out, _ = forward(p, inputs[at:end, :n], starts[at:end, :n], state[:n], live)
        state = out[-1]
        mask = np.arange(at, end)[:, None] < sizes[:n]
        own = np.zeros(mask.shape)
        own[mask] = log_probabilities(p, out[mask], targets[at:end, :n][mask].astype(np.int64))
        own = lane_sums[:n] + np.cumsum(own, axis=0)
        lane_sums[:n] = own[-1]
        over = by_end[np.searchsorted(ends[by_end], at, "right"):np.searchsorted(ends[by_end], end, "right")]
        sums[over] = own[ends[over] - 1 - at, lane[over]]
    # a lane's documents follow each other: each one's share is the rise since the one before it
    order = np.lexsort((first, lane))
    rise = np.diff(sums[order], prepend=0.0)
    fresh = first[order] == 0
    rise[fresh] = sums[order][fresh]
    found = np.empty(len(docs))
    found[order] = rise
    return found


# ---------------------------------------------------------------- Spark


_CODED = ("uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, entries binary, "
          "rare array<struct<word: binary, g: int>>")


def coded(docs: DataFrame, known) -> DataFrame:
    """Every document as the network's entries, what the common words give, and the words that have to be joined.

    A word outside ``COMMON`` is joined for both scores. One inside it but outside the network's list is known here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = known.value
        for batch in batches:
            for part in blocks_of(batch, 2):
                numbers, distinct, sizes = tokens_of(part.column(2))
                entry, base, share, group = [t.take(numbers) for t in v.look_up(distinct.to_numpy(zero_copy_only=False).tolist())]
                starts = np.cumsum(sizes) - sizes  # no text is empty: all have the end
                rare = group > -2  # to be joined
                at = np.flatnonzero(rare)
                n_rare = np.add.reduceat(rare.astype(np.int64), starts)
                found = pa.StructArray.from_arrays([distinct.take(pa.array(numbers[at])), pa.array(group[at])],
                                                   fields=list(kind.value_type))
                offsets = pa.array(np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([held_out(k) for k in part.column(1).to_pylist()]),
                    pa.array(sizes, pa.int64()), pa.array(sizes - n_rare, pa.int64()), pa.array(np.add.reduceat(base, starts)),
                    pa.array([entry[a:a + n].tobytes() for a, n in zip(starts, sizes)], pa.binary()),
                    pa.ListArray.from_arrays(offsets, found, type=kind), pa.array(np.add.reduceat(share, starts))],
                    schema=schema)

    fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
              ("n_known", pa.int64()), ("base", pa.float64()), ("entries", pa.binary()),
              ("rare", pa.list_(pa.struct([("word", pa.binary()), ("g", pa.int32())]))),
              ("shares", pa.float64())]
    schema = pa.schema(fields)
    kind = schema.field("rare").type
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    return numbered.mapInArrow(run, _CODED + ", shares double")


def fit(entries: DataFrame, mass: np.ndarray, tokens: int, shard_tokens: int = SHARD_TOKENS) -> Network:
    """Train on the rows of ``uid, entries``. Only the mean parameters reach the driver: a fixed number of values."""
    net = Network(mass)
    spark = entries.sparkSession
    shards = max(1, round(tokens / ROUNDS / shard_tokens))
    for round_ in range(ROUNDS):
        start = spark.sparkContext.broadcast(net.flat())

        def shard(rows: pa.Table) -> pa.Table:
            own = Network(mass)
            own.load(start.value)
            order = np.argsort(rows.column("uid").to_numpy(), kind="stable")
            data = rows.column("entries").to_pylist()
            seen = train(own, [np.frombuffer(data[i], np.int16) for i in order])
            flat = own.flat().astype(np.float64) * seen
            return pa.table({"i": np.arange(len(flat) + 1), "v": np.append(flat, seen)})

        mix = F.xxhash64(F.col("uid"))
        dealt = entries.filter(F.pmod(mix, F.lit(ROUNDS)) == round_).withColumn(
            "shard", F.pmod(F.shiftright(mix, 8), F.lit(shards)).cast("int"))
        sums = dealt.groupBy("shard").applyInArrow(shard, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
        found = sums.toArrow()
        if found.num_rows:
            flat = np.zeros(found.num_rows)
            flat[found.column("i").to_numpy()] = found.column("v").to_numpy()
            if flat[-1] > 0:
                net.load(flat[:-1] / flat[-1])
    return net


def scores(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Base and model score of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = written(word_counts(texts), "counts")
    vocab = vocabulary(counts)
    known = spark.sparkContext.broadcast(vocab)
    rows = written(coded(texts, known), "coded")
    net = fit(rows.filter("NOT held_out").select("uid", "entries"), vocab.mass, vocab.total, shard_tokens)
    params = spark.sparkContext.broadcast(net.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = [np.frombuffer(x, np.int16) for x in batch.column(1).to_pylist()]
            blocks = np.cumsum([len(x) for x in entries]) // SCORED_TOKENS  # rows that are scored together
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(entries)]
            for lo, hi in zip(edges, edges[1:]):
                own = score(params.value, entries[lo:hi])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(own / np.log(10))],
                                                 ["uid", "net"])

    scored = rows.select("uid", "entries").mapInArrow(run, "uid long, net double")
    # words that are not everywhere known, by their counts
    group_floor = F.array(*[F.lit(float(x)) for x in vocab.group_floor])
    rare = rows.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.g")

    logs = F.log10(F.coalesce("c", F.lit(0)) + F.lit(ALPHA))
    joined = rare.join(counts, "word", "left").select(
        "uid", "c", (logs - F.lit(float(np.log10(vocab.floor or 1)))).alias("b"),
        F.when(F.col("g") >= 0, logs - F.get(group_floor, "g")).otherwise(0.0).alias("s"))
    sums = joined.groupBy("uid").agg(F.sum("b").alias("b"), F.sum("s").alias("s"), F.count_if(F.col("c") > 0).alias("k"))
    zero = F.lit(0.0)
    return rows.drop("entries", "rare").join(scored, "uid").join(sums, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("net") + F.col("shares") + F.coalesce("s", zero)).alias("score"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return scores(table(spark, sf_dir, "documents"))


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
SQL: dict[str, str] = {}
