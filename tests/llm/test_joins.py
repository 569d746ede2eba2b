"""N-gram join, suffix dedup and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from quire.llm import ngram_join, suffixes

LONG = " ".join(f"w{i}" for i in range(20_000))


@pytest.fixture()
def folder(docs, tmp_path):
    def make(texts, ids=None):
        docs(texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return make


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 4]) for i in range(len(words) - 3))


def brute_components(ids, texts):
    sets, parent, inverted = [shingles(t) for t in texts], list(range(len(texts))), defaultdict(list)
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, own in enumerate(sets):
        for j, both in Counter(j for x in own for j in inverted[x]).items():
            if 100 * both >= 85 * (len(own) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for x in own:
            inverted[x].append(i)
    least = {}
    for i in range(len(texts)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return {ids[i]: (len(sets[i]), least[root(i)]) for i in range(len(texts))}


def corpus(seed, n=12):
    """Groups of near copies at all distances, shared passages, copies and odd texts."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}"
    passage = [word() for _ in range(60)]
    texts = [None, "", "  ", "One", "one", "two words", LONG, LONG + " end"]
    for _ in range(n):
        base = [word() for _ in range(rng.choice([5, 30, 120, 400]))]
        if rng.random() < 0.5:
            base[2:2] = passage
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            near = list(base)
            for _ in range(rng.randint(0, 6)):
                near[rng.randrange(len(near))] = word()
            texts += [" ".join(near)] * rng.choice([1, 1, 2])
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("part", [3, 2000])
def test_components(spark, docs, part):
    texts = corpus(part)
    ids = list(range(100, 100 + len(texts)))
    random.Random(1).shuffle(ids)
    df = docs(texts, ids).withColumnRenamed("lang", "key").withColumnRenamed("source", "comp")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(df, part=part).collect()}
    assert got == brute_components(ids, texts)


def test_a_chain_is_one_component(spark, docs):
    words = [f"t{i}" for i in range(200)]
    texts = [" ".join(words[:i] + [f"x{j}" for j in range(i)] + words[i:])[:100_000] for i in range(0, 12, 2)]
    steps = [" ".join(words[3 * i:3 * i + 120]) for i in range(20)]
    for some in (texts, steps):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs(some)).collect()}
        assert got == brute_components(list(range(len(some))), some)


def test_the_query_and_an_empty_table(spark, folder):
    assert ngram_join.op6_ngram_jaccard_join(spark, folder([])).collect() == []


def test_one_document_of_each_group_stays(spark, docs):
    texts = ["a b c d e f", "A b c d e f", None, "", "z y x w v", "z y x w v"]
    df = docs(texts, ids=[5, 3, 8, 9, 4, 4]).withColumnRenamed("lang", "first_id")
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 8, 9]
    assert ngram_join.one_of_each(docs([])).count() == 0
    assert ngram_join.one_of_each(docs(["p q r s t", "p q r s t"], ids=[None, None])).count() == 1


def brute_removed(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\x01" * width
        left = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared = [text(n) for n in (20, 39, 40, 41, 90, 300)]
    texts = [None, "", "short", "a" * 500, "ab" * 300, "é" * 200]
    for _ in range(25):
        parts = [text(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            cut = rng.randint(0, 10)
            parts += [piece[cut:], text(rng.randint(0, 60))]
        texts.append("".join(parts))
    return [*texts, texts[-1], texts[-2] + "tail"]


@pytest.mark.parametrize("width, part", [(40, 4), (40, 10), (24, 7)])
def test_exactly_the_repeated_bytes_go(spark, docs, width, part, monkeypatch):
    monkeypatch.setattr(suffixes, "PART", part)
    texts = passages(width + part)
    got = suffixes.digests(docs(texts), width).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == brute_removed(texts, width)
    left = {r["doc_id"]: r["text"] or "" for r in suffixes.remove_repeats(docs(texts), width).collect()}
    assert {r["doc_id"]: r["kept_text"] for r in got} == left


def test_suffix_query_at_full_width(spark, folder):
    passage = " ".join(f"p{i}" for i in range(120))
    texts = [f"{LONG[:3000]} {passage} one", f"x{passage}", "small", passage[:399], LONG, LONG, None]
    got = suffixes.op7_suffix_dedup(spark, folder(texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == brute_removed(texts, 400)
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_repeated_rows_and_texts_cut_inside_characters(spark, docs):
    same = "é" * 30 + "abc"
    df = docs([same, same, "ü" + same[1:], None], ids=[1, 1, 2, 3]).withColumnRenamed("lang", "spans")
    left = suffixes.remove_repeats(df, 40)
    assert left.columns == df.columns
    got = sorted((r["doc_id"], r["text"]) for r in left.collect())
    assert got[:2] == [(1, ""), (1, "")] and got[3] == (3, None) and got[2][1] in ("ü", "")
    assert suffixes.remove_repeats(docs([]), 40).count() == 0


def test_the_pipeline_stage_by_stage(spark, docs, tmp_path):
    import corpus_pipeline
    from quire.llm import quality

    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(["river", "stone", "cloud", "light", "green"]) + rng.choice("abcdefgh") + rng.choice("abcdefgh") for _ in range(n))
    passage, first = prose(80), prose(150)
    texts = [first, first, first + " more", prose(90) + " " + passage, passage + " " + prose(90), prose(60) + " card 4111111111111111 end",
             "# $ % " * 40, "too few", None, ""]
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "pii", "best_fit_packing"]
    df, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, str(tmp_path))
        seen[name] = {r["doc_id"]: r for r in df.collect()}
        if name != "best_fit_packing":
            assert df.columns == corpus_pipeline.COLUMNS
    assert set(seen["quality_rules"]) == {0, 1, 2, 3, 4, 5}
    assert set(seen["ngram_jaccard_join"]) == {0, 3, 4, 5}
    kept = [seen["ngram_jaccard_join"][i]["text"] for i in (0, 3, 4, 5)]
    for i, wanted in zip((0, 3, 4, 5), brute_removed(kept, 400)):
        r = seen["suffix_array_dedup"][i]
        assert hashlib.sha256(r["text"].encode()).hexdigest() == wanted[3] and r["n_chars"] == len(r["text"])
    assert seen["suffix_array_dedup"][3]["n_chars"] < len(texts[3])
    assert "4111111111111111" not in seen["pii"][5]["text"]
    assert set(seen["best_fit_packing"]) == {0, 3, 4, 5}
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in ran) == sorted(
        (r["doc_id"], r["ids_crc32"]) for r in seen["best_fit_packing"].values())
    assert quality.keep(docs([])).count() == 0


def test_the_pipeline_joins_at_five_words_and_four_fifths(spark, docs):
    """One word of ``n`` changed: similarity (n - 9) / (n + 1) of five words, (n - 7) / (n + 1) of four."""
    import corpus_pipeline

    texts = []
    for n in (48, 49, 50, 52, 53):
        words = [f"n{n}w{i}" for i in range(n)]
        texts += [" ".join(words), " ".join([*words[:20], "other", *words[21:]])]
    kept = {r["doc_id"] for r in corpus_pipeline.ngram_jaccard_join(spark, docs(texts), "").collect()}
    assert kept == {0, 1, 2, 4, 6, 8}  # 39/49 stays; 40/50, 41/51, 43/53 and 44/54 do not


def brute_words_removed(texts, words, width):
    """Texts without strings of ``width`` bytes and passages of ``words`` words that start twice or more (ASCII texts)."""
    import re

    seen, places = Counter(), []
    for d, t in enumerate(texts):
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", t))
        windows = [(tuple(m[0] for m in found[i:i + words]), found[i].start(), found[i + words - 1].end())
                   for i in range(len(found) - words + 1)]
        windows += [(t[i:i + width], i, i + width) for i in range(len(t) - width + 1)]
        seen.update(w for w, _, _ in windows)
        places += [(d, *w) for w in windows]
    gone = [bytearray(len(t)) for t in texts]
    for d, w, a, b in places:
        if seen[w] > 1:
            gone[d][a:b] = b"\x01" * (b - a)
    return ["".join(c for c, g in zip(t, x) if not g) for t, x in zip(texts, gone)]


def test_the_pipeline_removes_passages_of_over_fifty_words(spark, docs):
    import corpus_pipeline

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(n) for n in (30, 50, 51, 52, 59, 65, 65, 130)]
    texts = ["", "short"]
    for p in passages:
        for glue in (" ", " ", "  ", "\n"):
            texts.append(" ".join(prose(rng.randint(0, 40))) + " " + glue.join(p) + glue + " ".join(prose(rng.randint(0, 40))))
    texts.append(" ".join([*prose(9), *passages[2][:40], *prose(3), *passages[3][5:], *passages[4], *prose(4), *passages[4]]))
    texts.append("x" * 450 + " one"), texts.append("y " + "x" * 450)  # one word of 400 bytes
    df = docs([*texts, None], ids=[*range(len(texts)), 999])
    got = {r["doc_id"]: r for r in corpus_pipeline.suffix_array_dedup(spark, df, "").collect()}
    wanted = brute_words_removed(texts, 51, 400)
    assert [got[i]["text"] for i in range(len(texts))] == wanted and got[999]["text"] is None
    assert any(len(" ".join(p)) < 400 for p in passages if len(p) > 50)
    assert all(got[i]["n_chars"] == len(w) for i, w in enumerate(wanted))
