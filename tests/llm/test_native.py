"""Quality rules and pseudonyms against plain Python."""

import hashlib
import random
import re
import unicodedata
from datetime import date

import pytest

from quire.llm import personal, quality
from tests.conftest import plan_of

LONG = " ".join(f"w{i % 997}" for i in range(30_000))
HINDI = "यह एक साफ हिन्दी पाठ है जिसमें मात्राएँ बहुत"
JAPANESE = "これは日本語の文章でありカタカナも漢字も含まれています"
TEXTS = [
    None, "", " \n\t ", "few words", " ".join(f"word{i}" for i in range(40)), "a b c d e f g h " * 5, LONG,
    "x\ny z\nx\n \nx\ny z\n" + " ".join(f"q{i}" for i in range(30)), "# $ % " * 30, "é ü x " * 12, "one\x0btwo\x0cthree " * 9,
    "same same same same same same same same same", " ".join(f"v{i}!!" for i in range(30)), "HELLO THERE " + " ".join(f"WORD{i}" for i in range(30)),
    " ".join(HINDI.split()[i % 9] + "।" * (i % 5 == 0) + HINDI.split()[i * 7 % 9] for i in range(40)),
    " ".join(f"{JAPANESE[i % 20:]}。{JAPANESE[:20 + i]}" for i in range(25)), " ".join("supercalifragilistic" + "abcdefgh"[i % 8] * i for i in range(25)),
]


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(j for i in places for j in range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
    dup, letters = len(lines) - len(set(lines)), sum(unicodedata.category(c)[0] in "LM" for c in text)
    unspaced = sum(unicodedata.name(c, "").startswith(("CJK UNIFIED", "HIRAGANA", "KATAKANA L", "THAI")) for c in text)
    failed = n < 20 or 100 * len(covered) > 30 * n
    bad = (chars < 2 * n or chars > 12 * n and chars - unspaced > 12 * n or 10 * symbols > n or 2 * dup > len(lines) or 10 * letters < 7 * chars
           or 2 * sum(c.isupper() for c in text) > letters or 10 * text.count("!") > 3 * n)
    return n, chars, symbols, dup, len(covered), failed, not (failed or bad)


@pytest.fixture()
def folder(docs, tmp_path):
    def make(texts, ids=None):
        docs(texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return make


def test_measures_and_verdicts(spark, folder):
    texts = [*TEXTS, *TEXTS[:5]]
    got = quality.op4_quality_rules(spark, folder(texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [expected(t) for t in texts]


def test_clean_prose_of_other_scripts_is_kept(spark, folder):
    got = quality.op4_quality_rules(spark, folder(TEXTS[-3:])).orderBy("doc_id").collect()
    assert [r["kept"] for r in got] == [True, True, False]


def test_the_stage_splits_a_text_once(docs):
    plan = plan_of(quality.keep(docs(TEXTS)))
    assert plan.count(quality.SPACES) == 1


def test_quality_of_an_empty_table(spark, folder):
    df = quality.op4_quality_rules(spark, folder([]))
    assert df.count() == 0 and df.columns[:2] == ["doc_id", "n_words"]


def test_quality_filter_keeps_columns_and_runs_no_python(spark, docs):
    df = docs(TEXTS).withColumnRenamed("source", "words").withColumnRenamed("lang", "kept")
    kept = quality.keep(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(TEXTS) if expected(t)[-1]}
    assert "Python" not in plan_of(kept) and "Arrow" not in plan_of(kept)


def test_the_order_of_rules_never_changes_a_verdict(spark, docs):
    df = docs(TEXTS)
    words = df.withColumn("w", quality.words_of(df["text"]))
    names = quality.measures(words["text"], words["w"])
    orders = [list(quality.RULES), list(reversed(quality.RULES))]
    a, b = ([r[0] for r in words.select(quality.passes(names, o)).collect()] for o in orders)
    assert a == b == [expected(t)[-1] for t in TEXTS]
    assert quality.ordered({"dear": (10.0, 0.5), "cheap": (0.1, 0.2), "useless": (1.0, 0.0)}) == ["cheap", "dear", "useless"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_ok(text):
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


PERSONAL = [
    ("card 4111 1111 1111 1111 here", r"\d{4} \d{4} \d{4} \d{4}", lambda x: luhn(x.replace(" ", ""))),
    ("card 4111111111111111.", r"\d{16}", luhn),
    ("call +1 (578) 555-6437 now", r"\+1 \(\d{3}\) \d{3}-\d{4}", None),
    ("ip 97.51.17.173, ok", r"\d+\.\d+\.\d+\.\d+", lambda x: all(int(p) < 256 for p in x.split("."))),
    ("born 1984-02-29.", r"\d{4}-\d\d-\d\d", date.fromisoformat),
    ("born 31/12/1999.", r"\d\d/\d\d/\d{4}", lambda x: date(int(x[6:]), int(x[3:5]), int(x[:2]))),
    ("ssn 123-45-6789", r"\d{3}-\d{2}-\d{4}", None),
    ("iban GB82 WEST 1234 5698 7654 32 end", r"GB\d\d WEST(?: \d{4}){3} \d\d", iban_ok),
    ("mail äb.c+d@mail7.example.com!", r"u\d{16}@example\.invalid", None),
]


def test_pseudonyms_keep_the_format_and_stay_linked(spark, docs):
    texts = [t for t, _, _ in PERSONAL]
    both = " / ".join(texts)
    got = [r["text"] for r in personal.pseudonymise(docs([*texts, *texts, both])).orderBy("doc_id").collect()]
    n = len(texts)
    assert got[:n] == got[n:2 * n] and got[2 * n] == " / ".join(got[:n])
    for (text, form, check), new in zip(PERSONAL, got):
        assert new != text
        found = re.search(form, new)
        assert found and (check is None or check(found[0]) is not False), new
    other = [r["text"] for r in personal.pseudonymise(docs(texts), key="another").orderBy("doc_id").collect()]
    assert all(a != b for a, b in zip(got, other))


def test_what_is_not_valid_stays(spark, docs):
    texts = [None, "", "number 4111111111111112", "300.1.2.3", "1999-02-30", "000-12-3456", "GB83 WEST 1234 5698 7654 32",
             "a1234567890123456789b", "v1.2.3", "x@y", LONG]
    df = personal.pseudonymise(docs(texts).withColumnRenamed("lang", "found"), kinds_column="kinds")
    rows = df.orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == texts and all(r["kinds"] == "" for r in rows) and rows[0]["found"] == "en"
    assert "Python" not in plan_of(df)
    assert personal.pseudonymise(docs([])).count() == 0


def test_the_permutation_is_one(spark):
    from pyspark.sql import functions as F

    df = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    new = [r[0] for r in df.select(personal.permuted_digits(F.lit("k"), "t", F.col("d"))).collect()]
    assert sorted(new) == [f"{i:04d}" for i in range(10_000)] and sum(int(x) == i for i, x in enumerate(new)) < 10


def test_cards_and_ibans_beside_other_groups(spark, docs):
    card, iban = "4111 1111 1111 1111", "BE68 5390 0754 7034"
    cases = {
        f"{card} 12/27": [card], "4111111111111111 123": ["4111111111111111"], "12 4111111111111111": ["4111111111111111"],
        "3782 822463 10005 1234": ["3782 822463 10005"], f"12 34 56 {card} 99 {card.replace(' ', '-')}": [card, card.replace(" ", "-")],
        f"{iban} BIC": [iban], f"AB13 {iban} DE89 3704 0044 0532 0130 00 EUR": [iban, "DE89 3704 0044 0532 0130 00"],
        f"XX12 {card}": [card], f"{card} 555-123-4567": [card, "555-123-4567"], f"{card} 05/12/2027": [card, "05/12/2027"],
    }
    got = personal.pseudonymise(docs([*cases, "4111 1111 1111 1112 13", "BE68 5390 0754 7035 BIC"]), kinds_column="kinds")
    rows = {r["doc_id"]: r for r in got.collect()}
    for i, (text, gone) in enumerate(cases.items()):
        assert not any(g in rows[i]["text"] for g in gone), (text, rows[i]["text"])
        assert len(rows[i]["kinds"].split(",")) == len(gone) and len(rows[i]["text"]) == len(text)
    assert rows[0]["text"].endswith(" 12/27") and rows[5]["text"].endswith(" BIC") and rows[6]["text"].startswith("AB13 ")
    assert rows[len(cases)]["kinds"] == "" and rows[len(cases) + 1]["text"] == "BE68 5390 0754 7035 BIC"


def twin_card(digits, key=personal.KEY):
    """The pseudonym of a card, in plain Python."""
    issuer = re.match(personal.ISSUER, digits)[0]
    inner = digits[len(issuer):-1]
    n, left = len(inner), len(inner) // 2
    a, b, mod_a, mod_b = int(inner[:left]), int(inner[left:]), 10 ** left, 10 ** (n - left)
    for i in range(personal.ROUNDS):
        half, mod = (b, mod_a) if i % 2 == 0 else (a, mod_b)
        digest = int(hashlib.sha256(f"{key}|card{n}|{i}|{half}".encode()).hexdigest()[:15], 16) % mod
        a, b = ((a + digest) % mod_a, b) if i % 2 == 0 else (a, (b + digest) % mod_b)
    body = issuer + str(a).zfill(left) + str(b).zfill(n - left)
    return next(body + last for last in "0123456789" if luhn(body + last))


def test_cards_are_those_of_the_plain_twin(spark, docs):
    """Random digit strings alone in a text: those that a card may be are replaced as the twin does, others stay."""
    rng = random.Random(3)
    numbers = ["".join(rng.choice("0123456789") for _ in range(rng.randint(12, 20))) for _ in range(300)]
    numbers += ["4" + n[1:] for n in numbers]
    rows = personal.pseudonymise(docs([f"no. {n}, paid" for n in numbers])).orderBy("doc_id").collect()
    changed = 0
    for n, r in zip(numbers, rows):
        valid = 13 <= len(n) <= 19 and luhn(n) and re.match(personal.ISSUER, n)
        assert r["text"] == f"no. {twin_card(n) if valid else n}, paid", n
        changed += bool(valid)
    assert changed > 20


def test_lists_of_numbers_are_no_cards(spark, docs):
    texts = ["Sales 1998 2001 2004 2007 2010 2013", " ".join(map(str, range(1900, 2030))), "9999 9999 9999 9995",
             "4111-1111 1111-1111", "0000 0000 0000 0000"]
    rows = personal.pseudonymise(docs(texts), kinds_column="kinds").orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == texts and all(r["kinds"] == "" for r in rows)
