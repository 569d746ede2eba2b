"""Periodic runs against brute force, and grammar extensions against plain comparison."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import periodic

SF = "/root/testdata/sf0.01"


def brute(words, least=12):
    """``(start, length, period)`` of every run, by trying all periods over the whole text."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def mine(texts, least=12):
    out = [[] for _ in texts]
    for t, s, m, q in zip(*periodic.runs([np.array(t, np.int64) for t in texts], least)):
        out[t].append((int(s), int(m), int(q)))
    return [sorted(o) for o in out]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4), st.sampled_from([2, 12]))
def test_random_texts(texts, least):
    assert mine(texts, least) == [brute(t, least) for t in texts]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("text", [
    [], [0], [0] * 500, [0, 1] * 300, [0, 0, 1] * 100 + [0, 0], fibonacci(600), [0] * 40 + [1] * 40 + [0] * 40,
    list(range(50)) * 7 + [3] * 13, [int(c) for c in bin(0x5A5A_1234_9999_ABCD_0F0F ** 9)[2:]],
    [bin(i).count("1") % 2 for i in range(700)],
])
def test_known_shapes(text):
    assert mine([text, text, [9]]) == [brute(text), brute(text), []]


def test_planted_periods_in_random_words():
    rng = random.Random(1)
    texts = []
    for _ in range(40):
        t = [rng.randint(0, 30) for _ in range(rng.randint(1, 400))]
        a = rng.randrange(len(t))
        p = 1 + (len(t) - a) // rng.randint(3, 10)
        texts.append(t[:a] + [t[a + (i - a) % p] for i in range(a, len(t))])
    assert mine(texts) == [brute(t) for t in texts]


def test_extensions_against_comparison():
    rng = random.Random(2)
    text = [rng.randint(2, 3) for _ in range(300)]
    line = np.array([0, *text, *text[50:200], 2, *text, 1])
    grammar = periodic.Grammar(line, 2)
    a, b = np.array([(rng.randrange(1, len(line) - 2), 0) for _ in range(4000)]).T
    b = np.array([rng.randrange(int(x) + 1, len(line)) for x in a])
    ahead, back = grammar.agree(a, b, True), grammar.agree(a, b, False)
    for x, y, f, g in zip(a.tolist(), b.tolist(), ahead.tolist(), back.tolist()):
        k = 0
        while y + k < len(line) and line[x + k] == line[y + k]:
            k += 1
        assert f == k
        k = 0
        while x - k >= 0 and line[x - k] == line[y - k]:
            k += 1
        assert g == k


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark):
    got = periodic.op11_periodic_runs(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(docs)
    some = 0
    for r in got:
        if len(docs[r["doc_id"]] or "") < 8000:
            some += r["n_runs"] > 0
            assert tuple(r)[1:] == expected(r["doc_id"], docs[r["doc_id"]])
    assert some > 50


def test_odd_texts(docs):
    long = " ".join(f"w{i}" for i in range(3000))
    texts = [None, "", " \t\n ", "one", "a " * 12, "a\x0bb\x0c" * 6, "x x " * 11, f"{long} {long}", "é ü " * 9, "a " * 12]
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs(texts)).collect()}
    assert [got[i]["n_runs"] for i in range(10)] == [0, 0, 0, 0, 1, 1, 0, 1, 1, 1]
    assert [got[i]["collapsed"] for i in (0, 4, 5, 8, 7)] == ["", "a", "a b", "é ü", long]
    assert tuple(got[7])[1:6] == (1, 0, 6000, 3000, 2000)
    assert tuple(got[4])[1:] == tuple(got[9])[1:]


def test_null_ids_and_an_empty_table(spark, docs):
    rows = periodic.periodic_runs(docs(["a b " * 8, "c"], ids=[None, 1]), plant=True).collect()
    assert sorted(r["n_runs"] for r in rows) == [0, 1]
    assert periodic.periodic_runs(docs([]), plant=True).collect() == []


def test_groups_do_not_change_results(docs, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(30)]
    whole = [tuple(r) for r in periodic.periodic_runs(docs(texts)).orderBy("doc_id").collect()]
    batches = [t.encode().split() for t in texts]
    monkeypatch.setattr(periodic, "WORDS_AT_ONCE", 50)
    monkeypatch.setattr(periodic, "QUERIES_AT_ONCE", 5)
    parts = list(periodic._grouped([t.encode() for t in texts], [None] * 30, False))
    assert sum(parts, []) == batches and len(parts) > 5
    assert [r[:5] for p in parts for r in periodic._rows(p, 12)] == [r[1:6] for r in whole]
