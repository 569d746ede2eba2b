"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A document is kept when no rule rejects it. Rules differ in cost and in how much they reject, so the order matters:
each rule is timed and counted on a sample, and rules run by rejected share per second, the best first. A ``CASE``
holds the cascade, and Spark evaluates its branches only until one is true. The order never changes a verdict.

The 8-word windows of a document are compared by a 64-bit hash of their words' 64-bit hashes; within a document of
20,000 words two different windows share one with a chance of about 1e-11.

Defined cases: a null text has no words and is rejected, as is an empty one; repeated rows get equal verdicts; an
empty table gives an empty result; other columns, of any name, pass through ``keep`` and are not looked at.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import fresh, table, written

SAMPLE_ROWS = 2000  # rows on which cost and selectivity are estimated; results do not depend on it
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
SPACES = r"[\x20\x09-\x0D]+"
LETTERS = r"[\p{L}\p{M}]"  # many scripts write vowels as marks
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"  # no blanks between words

Measures = Mapping[str, Callable[[], Column]]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more, first occurrences included."""

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(found: Column) -> Column:
            def twice(entry: Column, at: Column) -> Column:
                before = F.get(found, at - 1)["h"]
                after = F.get(found, at + 1)["h"]
                return F.coalesce(entry["h"] == before, F.lit(False)) | F.coalesce(entry["h"] == after, F.lit(False))

            return F.sort_array(F.transform(F.filter(found, twice), lambda e: e["i"]))

        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("sum"))
        step = lambda acc, i: F.struct(
            i.alias("last"), (acc["sum"] + F.least(F.lit(width), i - acc["last"])).alias("sum"))
        return F.aggregate(_let(ordered, starts), start, step, lambda acc: acc["sum"])

    def windows(codes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(codes) - width)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(codes, i + k) for k in range(width)]))

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    codes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(_let(_let(codes, windows), count)).cast("long")


def removed(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match a one-character pattern."""
    whole = F.coalesce(text, F.lit(""))
    return (F.length(whole) - F.length(F.regexp_replace(whole, pattern, ""))).cast("long")


def measures(text: Column, words: Column) -> dict[str, Callable[[], Column]]:
    """What the rules look at, by name; each is built when a rule asks for it."""
    return {
        "n_words": lambda: F.size(words).cast("long"),
        "word_chars": lambda: F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": lambda: removed(text, SYMBOLS),
        "n_lines": lambda: F.size(lines_of(text)).cast("long"),
        "n_dup_lines": lambda: _let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": lambda: repeated_words(words),
        "n_letters": lambda: removed(text, LETTERS),
        "n_unspaced": lambda: removed(text, UNSPACED),
        "n_capitals": lambda: removed(text, r"\p{Lu}"),
        "n_exclamations": lambda: removed(text, "!"),
    }


# Rule -> when it rejects. Thresholds are whole-number ratios, so no engine rounds them.
BASE_RULES: dict[str, Callable[[Measures], Column]] = {
    "few_words": lambda m: m["n_words"]() < 20,
    "repeated": lambda m: 100 * m["n_repeat_words"]() > 30 * m["n_words"](),
}
RULES: dict[str, Callable[[Measures], Column]] = BASE_RULES | {
    "short_words": lambda m: m["word_chars"]() < 2 * m["n_words"](),
    "long_words": lambda m: (m["word_chars"]() > 12 * m["n_words"]()) & (m["word_chars"]() - m["n_unspaced"]() > 12 * m["n_words"]()),
    "symbols": lambda m: 10 * m["n_symbols"]() > m["n_words"](),
    "duplicate_lines": lambda m: 2 * m["n_dup_lines"]() > m["n_lines"](),
    "few_letters": lambda m: 10 * m["n_letters"]() < 7 * m["word_chars"](),
    "capitals": lambda m: 2 * m["n_capitals"]() > m["n_letters"](),
    "exclamations": lambda m: 10 * m["n_exclamations"]() > 3 * m["n_words"](),
}


def estimate(docs: DataFrame, rules: Mapping[str, Callable[[Measures], Column]] = RULES, text_column: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Rule -> (seconds, rejected share) on a sample of the documents."""
    rows = docs.count()
    if not rows:
        return {name: (1.0, 0.0) for name in rules}
    text = docs.select(F.col(text_column).cast("string").alias("_q_text"))
    sample = written(text.sample(min(1.0, sample_rows / rows), seed=17).repartition(2), "sample")
    prepared = sample.withColumn("_q_words", words_of(F.col("_q_text")))
    names = measures(F.col("_q_text"), F.col("_q_words"))

    def timed(column: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):  # the first run also compiles
            start = time.perf_counter()
            share = prepared.agg(F.avg(column.cast("int"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - start)
        return best, share

    floor = timed(F.lit(False))[0]
    found = {name: timed(rule(names)) for name, rule in rules.items()}
    return {name: (max(1e-3, seconds - floor), share) for name, (seconds, share) in found.items()}


def ordered(estimates: Mapping[str, tuple[float, float]]) -> list[str]:
    """Rules by rejected share per second, the best first."""
    return sorted(estimates, key=lambda name: (-estimates[name][1] / estimates[name][0], estimates[name][0]))


def passes(names: Measures, order: list[str], rules: Mapping[str, Callable[[Measures], Column]] = RULES) -> Column:
    """The cascade: false at the first rule that rejects."""
    verdict = F.when(F.lit(False), F.lit(False))
    for name in order:
        verdict = verdict.when(rules[name](names), F.lit(False))
    return verdict.otherwise(F.lit(True))


def keep(docs: DataFrame, rules: Mapping[str, Callable[[Measures], Column]] = RULES,
         text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns as they were."""
    order = ordered(estimate(docs, rules, text_column))
    words, kept = fresh(docs, "words"), fresh(docs, "kept")
    # a generator: below it the filter cannot slide, where every rule would split the text again
    split = docs.select("*", F.explode(F.array(words_of(F.col(text_column)))).alias(words))
    names = measures(F.col(text_column), F.col(words))
    return split.withColumn(kept, passes(names, order, rules)).filter(F.col(kept)).select(*docs.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = ordered(estimate(docs))
    split = docs.withColumn("_q_words", words_of(F.col("text")))
    named = measures(F.col("text"), F.col("_q_words"))
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measured = split.select("doc_id", "text", "_q_words", *[named[n]().alias(n) for n in shown])
    known = named | {n: (lambda n=n: F.col(n)) for n in shown}
    base = F.lit(False)
    for rule in BASE_RULES.values():
        base = base | rule(known)
    return measured.select("doc_id", *shown, base.alias("base_failed"), passes(known, order).alias("kept"))


_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), s AS (
    SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM d
), p AS (
    SELECT r, unnest(generate_series(1, len(w) - 7)) AS i, w FROM s WHERE len(w) >= 8
), win AS (
    SELECT r, i, array_to_string(w[i:i + 7], ' ') AS x FROM p
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n >= 2
), cover AS (
    SELECT r, least(8, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -8)) AS c FROM twice
), rep AS (
    SELECT r, sum(c)::BIGINT AS n FROM cover GROUP BY r
), m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
           len(l) AS n_lines, length(t) - length(regexp_replace(t, '[\p{L}\p{M}]', '', 'g')) AS n_letters,
           length(t) - length(regexp_replace(t, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]', '', 'g'))
             AS n_unspaced,
           length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_capitals,
           length(t) - length(replace(t, '!', '')) AS n_exclamations
    FROM s LEFT JOIN rep USING (r)
), b AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words AND word_chars - n_unspaced > 12 * n_words
            OR 10 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines OR 10 * n_letters < 7 * word_chars OR 2 * n_capitals > n_letters
            OR 10 * n_exclamations > 3 * n_words) AS kept
FROM b
"""

QUERIES = {"op4_quality_rules": op4_quality_rules}
SQL = {"op4_quality_rules": _SQL}
