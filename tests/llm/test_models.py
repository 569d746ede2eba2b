"""Language model and neighbours against plain versions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import language_model as lm
from quire.llm import neighbours as nn


def prose(seed, n):
    rng = random.Random(seed)
    kinds = [[f"{p}{i}" for i in range(40)] for p in ("the", "der", "les")]
    return [" ".join(rng.choice(kinds[d % 3]) for _ in range(rng.randint(5, 60))) for d in range(n)]


@pytest.fixture()
def folder(docs, tmp_path):
    def make(texts, ids=None):
        docs(texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return make


def test_base_scores_and_a_better_model(spark, folder):
    texts = [None, "", "Never seen words", "the1 " * 30_000, *prose(1, 1500)]
    rows = {r["doc_id"]: r for r in lm.op8_lm_scoring(spark, folder(texts)).collect()}
    words = {i: (t or "").encode().lower().split() + [b""] for i, t in enumerate(texts)}
    count = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, floor = sum(count.values()), math.log10(sum(count.values()) + 0.1 * (len(count) + 1))
    for i, ws in words.items():
        r = rows[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10(count[w] + 0.1) - floor for w in ws), rel=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])
    held = [r for i, r in rows.items() if r["held_out"] and i > 3]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_and_no_training_document(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 20)
    texts = prose(2, 60)
    rows = lm.scores(docs(texts)).collect()
    words = {i: t.encode().lower().split() + [b""] for i, t in enumerate(texts)}
    count = Counter(w for i, ws in words.items() if not lm.held_out(i) for w in ws)
    floor = math.log10(sum(count.values()) + 0.1 * (len(count) + 1))
    for r in rows:
        assert r["base_score"] == pytest.approx(sum(math.log10(count[w] + 0.1) - floor for w in words[r["doc_id"]]), rel=1e-9)
        assert r["n_known"] == sum(count[w] > 0 for w in words[r["doc_id"]])
    alone = lm.scores(docs(["some words"], ids=[None])).collect()[0]
    assert alone["held_out"] and alone["train_tokens"] == 0 and alone["n_known"] == 0 and math.isfinite(alone["score"])
    assert lm.scores(docs([])).count() == 0


def test_common_words_by_a_threshold(spark):
    rng = random.Random(6)
    for most in (0, 1, 5, 40, 1000):
        held = [max(1, int(rng.paretovariate(0.6))) for _ in range(300)]
        counts = spark.createDataFrame([(str(i).encode(), c) for i, c in enumerate(held)], "word binary, c long")
        least = lm.least_common(counts, most)
        assert sum(c >= least for c in held) <= most or least <= 0
        assert least <= 0 or sum(c >= max(x for x in [0, *held] if x < least) for c in held) > most
    assert lm.least_common(counts.limit(0), 5) == 0


def _net():
    return lm.Network(np.sort(np.random.default_rng(0).random(lm.ENTRIES))[::-1] + 0.01)


def test_probabilities_sum_to_one():
    net = _net()
    hidden = np.random.default_rng(1).standard_normal((1, lm.HIDDEN)).astype(np.float32)
    every = lm.log_probabilities(net.p, np.repeat(hidden, lm.ENTRIES, axis=0), np.arange(lm.ENTRIES))
    assert np.exp(every.astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_are_slopes():
    rng, net = np.random.default_rng(0), _net()
    p = {k: v.astype(np.float64) * (3 if k in ("x", "f", "n", "c", "w") else 1) for k, v in net.p.items()}
    targets, starts = rng.integers(0, lm.ENTRIES, (6, 4)), rng.random((6, 4)) < 0.2
    starts[0], mask = True, np.ones((6, 4), bool)
    mask[-2:, -1] = False
    inputs = lm._inputs(targets.astype(np.int16), starts).astype(int)
    state = np.zeros((4, lm.HIDDEN), np.float32)

    def loss():
        out, _ = lm.forward(p, inputs, starts, state.copy())
        return -lm.log_probabilities(p, out[mask], targets[mask]).astype(np.float64).sum() / mask.sum()

    grads, (ids, rows), _ = lm._gradients(p, inputs, targets, starts, mask, state.copy())
    for key in ("f", "n", "c", "cb", "x"):
        for _ in range(4):
            at = tuple(int(rng.integers(0, s)) for s in p[key].shape)
            if key == "x":
                row = int(rng.integers(0, len(ids)))
                at, slope = (int(ids[row]), at[1]), rows[row, at[1]]
            else:
                slope = grads[key][at]
            old = p[key][at]
            p[key][at] = old + 1e-2
            up = loss()
            p[key][at] = old - 1e-2
            down = loss()
            p[key][at] = old
            assert slope == pytest.approx((up - down) / 2e-2, abs=2e-4)


def test_the_whole_unit_and_its_sizes():
    """A reset and an update gate over 24 states, 1024 entries, four million tokens a shard."""
    assert (lm.HIDDEN, lm.ENTRIES, lm.LANES, lm.SHARD_TOKENS) == (24, 1024, 128, 4_000_000)
    p, size = _net().p, lm.HIDDEN
    p["nb"] = np.linspace(-1, 1, size).astype(np.float32)
    inputs, h = np.array([[3, lm.ENTRIES]]), np.random.default_rng(5).standard_normal((2, size)).astype(np.float32)
    x, gates = p["x"][inputs[0]], h @ p["f"]
    r = 1 / (1 + np.exp(-x[:, :size] - gates[:, :size]))
    z = 1 / (1 + np.exp(-x[:, size:2 * size] - gates[:, size:]))
    n = np.tanh(x[:, 2 * size:] + r * (h @ p["n"] + p["nb"]))
    out, _ = lm.forward(p, inputs, np.zeros((1, 2), bool), h)
    assert np.allclose(out[0], (1 - z) * n + z * h, atol=1e-5)


def test_the_state_is_carried_through_a_document():
    net, rng = _net(), np.random.default_rng(2)
    docs = [rng.integers(0, lm.ENTRIES, n).astype(np.int16) for n in (1, 300, 63, 64, 65, 1, 128)]
    together = lm.score(net.p, docs, lanes=3)
    assert np.allclose(together, [lm.score(net.p, [d])[0] for d in docs], rtol=1e-4)


def test_tokens_are_split_once_and_looked_up_by_distinct_word():
    texts = [None, "", " ", "a", " A\x0b\x0cb ", "Ä ä\u00a0ß\u2028x", *(f"p{chr(i)}Q {chr(i)}" for i in range(128)), *["again And again"] * 500]
    numbers, words, sizes = lm.tokens_of(pa.array(texts, pa.string()))
    wanted = [[*(t or "").encode().lower().split(), lm.END] for t in texts]
    assert sizes.tolist() == [len(w) for w in wanted]
    assert [words[i].as_py() for i in numbers.tolist()] == [w for ws in wanted for w in ws]
    assert len(words) == len({w for ws in wanted for w in ws})
    assert len(lm.tokens_of(pa.array([], pa.string()))[0]) == 0


def test_blocks_of_texts_hold_every_row(monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 10)
    texts = ["x" * 25, "", None, "abc", "d" * 9, "e" * 40, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts, pa.string())], ["i", "t"])
    blocks = [b.column(1).to_pylist() for b in lm.blocks_of(batch, 1)]
    assert [t for b in blocks for t in b] == texts and len(blocks) > 2
    assert [b.num_rows for b in lm.blocks_of(batch.slice(0, 0), 1)] in ([], [0])


def test_sums_by_id():
    rng = np.random.default_rng(4)
    ids, blocks = rng.zipf(1.5, 700).clip(max=90).astype(np.int16), rng.standard_normal((3, 700, 8)).astype(np.float32)
    found, sums = lm._sums_by(ids, blocks)
    assert found.tolist() == sorted(set(ids.tolist()))
    assert np.allclose(sums, np.stack([blocks[:, ids == i].sum(axis=1) for i in found], axis=1), atol=1e-4)


def test_scores_of_a_trained_net_by_plain_steps():
    net, rng, size = _net(), np.random.default_rng(7), lm.HIDDEN
    docs = [rng.zipf(1.3, n).clip(max=lm.ENTRIES - 1).astype(np.int16) for n in (1, 30, 900, 70, 5)]
    assert lm.train(net, docs) == sum(map(len, docs))
    p = {k: v.astype(float) for k, v in net.p.items()}
    plain = []
    for doc in docs:
        h, before, total = np.zeros(size), lm.ENTRIES, 0.0
        for word in doc.tolist():
            x, gates = p["x"][before], h @ p["f"]
            r, z = (1 / (1 + np.exp(-x[i:i + size] - gates[i:i + size])) for i in (0, size))
            n = np.tanh(x[2 * size:] + r * (h @ p["n"] + p["nb"]))
            h, c, before = n + z * (h - n), word // lm.CLASS, word
            for scores, at in ((h @ p["c"] + p["cb"], c), (h @ p["w"][c] + p["wb"][c], word % lm.CLASS)):
                total += scores[at] - np.log(np.exp(scores).sum())
        plain.append(total)
    assert np.allclose(lm.score(net.p, docs), plain, rtol=1e-4)


# ---------------------------------------------------------------- neighbours


def table(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], v, 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int")


def brute(vectors, ids, k=5):
    good = {i: np.array(v, np.float32).astype(float) for i, v in zip(ids, vectors)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if q % 50 == 0:
            scores = [(-float(good[q] @ v / (np.linalg.norm(good[q]) * np.linalg.norm(v))), i)
                      for i, v in good.items() if i != q and len(v) == len(good[q])]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 32))
    vectors = (centres[rng.integers(0, 20, 3000)] + 0.7 * rng.standard_normal((3000, 32))).astype(np.float32).tolist()
    got = found(nn.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0, sample=500, cell_rows=300))
    wanted = brute(vectors, range(3000))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values())) and set(got) == set(wanted)
    for q, hits in got.items():
        for i, s in hits:
            a, b = np.array(vectors[q], float), np.array(vectors[i], float)
            assert s == pytest.approx(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), abs=1e-12)


def test_odd_vectors_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], *[[1.0, 0.0]] * 20, [2.0, 0.0], [0.0, 1.0],
               [1.0, 1.0, 1.0], [1e-30, 1e-30]]
    ids = [0, *range(101, 101 + len(vectors) - 1)]
    ids[-4], ids[-2] = 50, 100
    got = found(nn.nearest(table(spark, vectors, ids), F.col("vec_id") % 50 == 0))
    wanted = brute(vectors, ids)
    assert [i for i, _ in got[0]] == [i for i, _ in wanted[0]] and [i for i, _ in got[50]] == [i for i, _ in wanted[50]]
    assert 100 not in got  # nothing of its length
    two = table(spark, [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0]], [0, 1, 1])
    assert [i for i, _ in found(nn.nearest(two, F.col("vec_id") == 0))[0]] == [1, 1]
    assert nn.nearest(table(spark, []), F.col("vec_id") == 0).count() == 0


def test_the_query_of_a_repeated_id_is_its_smallest_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.1, 1.0]), (2, [1.0, 0.1])]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "vec_id long, embedding array<float>").repartition(3)
        got = nn.nearest(df, F.col("vec_id") == 0, k=1).collect()
        assert [(r["query_id"], r["vec_id"]) for r in got] == [(0, 1)]


def test_the_stopping_test_is_the_distribution():
    rng = np.random.default_rng(4)
    sample = (rng.standard_normal((200_000, nn.M)) ** 2).sum(axis=1)
    for p in (0.5, 0.9, 0.98):
        assert (sample <= nn.quantile(p)).mean() == pytest.approx(p, abs=0.01)


def test_a_search_stops_at_98_percent():
    assert nn.CONFIDENCE == 0.98
