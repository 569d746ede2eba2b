"""The analysis queries over the shredded search-index table.

Every function takes that table and returns a lazy DataFrame. Cut-offs, search terms and list lengths are
parameters; the defaults are the values the reports are usually run with. Each reads only the columns it
names, and filters sit directly on the scan so that Parquet can skip row groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import values as V
from quire.functions.columns import UNIFIED, search, unified
from quire.operators.summaries import compute_once, count_by, number_summary, ranked, with_share


_BOOK = {
    "filename": "original_filename_best",
    "title": "title_best",
    "author": "author_best",
    "publisher": "publisher_best",
    "year": "year_best",
    "filesize": "filesize_best",
    "extension": "extension_best",
    "cover_url": "cover_url_best",
}


def _book_columns(*names: str) -> list:
    return [F.col(unified(_BOOK[n])).alias(n) for n in names]


def cover_sources(df: DataFrame, hosts: Mapping[str, str] = V.COVER_HOSTS) -> DataFrame:
    """Q01. Records per cover image host."""
    url = F.col(unified("cover_url_best"))
    labelled = df.filter(url.isNotNull()).select(V.cover_source(url, hosts).alias("cover_source"))
    return ranked(count_by(labelled, "cover_source"), "count", ["cover_source"])


def filename_search(df: DataFrame, text: str, limit: int = 10) -> DataFrame:
    """Q02. Records whose original file name matches ``%text%`` (``_`` and ``%`` are wildcards)."""
    hits = df.filter(F.col(unified("original_filename_best")).like(f"%{text}%"))
    return (
        hits.select("_id", *_book_columns(*_BOOK))
        .orderBy(F.col("filename").asc_nulls_last(), F.col("_id").asc_nulls_last())
        .limit(limit)
        .drop("_id")
    )


def id_lookup(df: DataFrame, record_id: str, limit: int = 10) -> DataFrame:
    """Q03. Records with one id; the equality reaches Parquet (statistics and bloom filter)."""
    hits = df.filter(F.col("_id") == F.lit(record_id)).select(F.col("_id").alias("id"), *_book_columns(*_BOOK))
    return hits.orderBy(F.col("filename").asc_nulls_last(), F.col("title").asc_nulls_last()).limit(limit)


def file_sizes(df: DataFrame, min_count: int = 1000) -> DataFrame:
    """Q04. File size in MiB by content type; sizes that are no number count but are not averaged."""
    size = F.col(unified("filesize_best"))
    sized = df.filter(size.isNotNull()).select(
        F.col(unified("content_type_best")).alias("content_type"), V.size_mb(size).alias("mb")
    )
    stats = sized.groupBy("content_type").agg(
        F.count(F.lit(1)).alias("count"),
        *number_summary("mb", "avg_size_mb", "min_size_mb", "max_size_mb", rounded=True),
    )
    return ranked(stats.filter(F.col("count") > min_count), "avg_size_mb", ["content_type"])


def classifications(df: DataFrame, min_count: int = 100) -> DataFrame:
    """Q05. Collection / holdings / content-type triples from the classification object.

    One parse of the object yields all three arrays.
    """
    parsed = df.select(
        F.from_json(
            unified("classifications_unified"),
            "ia_collection array<string>, oclc_holdings array<string>, content_type array<string>",
            {"mode": "PERMISSIVE"},
        ).alias("c")
    )
    triples = compute_once(
        parsed,
        F.get("c.ia_collection", F.lit(0)).alias("collection"),
        F.get("c.oclc_holdings", F.lit(0)).alias("holdings"),
        F.get("c.content_type", F.lit(0)).alias("content_type"),
    ).filter(F.col("collection").isNotNull())
    counts = count_by(triples, "collection", "holdings", "content_type", min_count=min_count)
    return ranked(counts, "count", ["collection", "holdings", "content_type"])


def access_types(df: DataFrame) -> DataFrame:
    """Q06. Access types with their share of all listed access types; a text that is no list is an error."""
    entries = df.select(F.explode(V.json_strings(search("search_access_types"))).alias("access_type"))
    return ranked(with_share(count_by(entries, "access_type")), "count", ["access_type"])


def rank_scores(df: DataFrame, min_count: int = 100) -> DataFrame:
    """Q07. Base rank by content type; a score that is no number is an error. The cast alone would read ``5f`` as 5."""
    rank = F.col(search("search_score_base_rank"))
    wrong = F.raise_error(F.concat(F.lit("not a number: "), rank)).cast("float")
    number = F.when(rank.rlike(r"[0-9.][fFdD]\s*$"), wrong).otherwise(rank.cast("float"))
    scored = df.filter(rank.isNotNull()).select(
        F.col(unified("content_type_best")).alias("content_type"), number.alias("rank")
    )
    stats = scored.groupBy("content_type").agg(
        F.count(F.lit(1)).alias("count"), *number_summary("rank", "avg_rank", "min_rank", "max_rank")
    )
    return ranked(stats.filter(F.col("count") > min_count), "avg_rank", ["content_type"])


def title_lengths(df: DataFrame, min_count: int = 100) -> DataFrame:
    """Q08. Title length in code points by content type."""
    title = F.col(unified("title_best"))
    measured = df.filter(title.isNotNull()).select(
        F.col(unified("content_type_best")).alias("content_type"), V.text_length(title).alias("n")
    )
    stats = measured.groupBy("content_type").agg(
        F.count(F.lit(1)).alias("count"), *number_summary("n", "avg_length", "min_length", "max_length")
    )
    return ranked(stats.filter(F.col("count") > min_count), "avg_length", ["content_type"])


def publication_years(df: DataFrame, lo: int = 1900, hi: int = 2025) -> DataFrame:
    """Q09. Records per year between ``lo`` and ``hi``; the range is applied before grouping."""
    years = compute_once(df, V.try_int(search("search_year")).alias("publish_year"))
    counts = count_by(years.filter(F.col("publish_year").between(lo, hi)), "publish_year")
    return counts.orderBy("publish_year")


def books_by_author(df: DataFrame, author: str) -> DataFrame:
    """Q10. All records of one author, newest first. The name is a literal, never SQL text."""
    hits = df.filter(F.col(unified("author_best")) == F.lit(author)).select(
        *_book_columns("title", "author", "publisher"),
        V.try_int(unified("year_best")).alias("publish_year"),
        *_book_columns("cover_url"),
    )
    return hits.orderBy(F.col("publish_year").desc_nulls_last(), F.col("title").asc_nulls_last())


def holdings_text(df: DataFrame):
    """Holdings as JSON text from the narrowest column the table has."""
    own = unified("classifications_unified_oclc_holdings")
    if own in df.columns:
        return F.col(own)
    if unified("classifications_unified") in df.columns:
        return F.get_json_object(unified("classifications_unified"), "$.oclc_holdings")
    return F.get_json_object(UNIFIED, "$.classifications_unified.oclc_holdings")


def rare_books(df: DataFrame, marker: str = "many") -> DataFrame:
    """Q11. Rare versus not rare, by library holdings."""
    held = df.select(holdings_text(df).alias("held"))
    counts = count_by(held.select(V.rarity(F.col("held"), marker).alias("rarity")), "rarity")
    return counts.orderBy("rarity")


def books_by_decade(df: DataFrame, exact_reference: bool = False) -> DataFrame:
    """Q12. Records per decade. ``exact_reference`` keeps the known float division, one group per year."""
    years = compute_once(df, V.try_int(search("search_year")).alias("year")).filter(F.col("year").isNotNull())
    year = F.col("year")
    decade = (year / 10) * 10 if exact_reference else (F.floor(year / 10) * 10).cast("int")
    return count_by(years.select(decade.alias("decade")), "decade").orderBy("decade")


def edition_variations(
    df: DataFrame, min_variations: int = 1, limit: int = 10, as_rows: bool = True
) -> DataFrame:
    """Q13. Main editions with the most distinct further edition statements.

    Distinct (main, variation) pairs are shuffled on both columns, so one frequent main edition spreads
    over all tasks. The pairs of the ``limit`` winners are returned one per row; ``as_rows=False`` gathers them into
    lists, for lists that fit a row. A text that is no list is an error.
    """
    main = F.col(unified("edition_varia_best"))
    listed = df.filter(main.isNotNull()).select(
        main.alias("main_edition"),
        F.explode(V.json_strings(unified("edition_varia_additional"))).alias("variation"),
    )
    pairs = listed.filter(F.col("variation").isNotNull()).distinct()
    counts = count_by(pairs, "main_edition", min_count=min_variations, count="edition_variations")
    winners = ranked(counts, "edition_variations", ["main_edition"], limit)
    detail = pairs.join(winners, "main_edition")
    order = [F.col("edition_variations").desc(), F.col("main_edition")]
    if as_rows:
        return detail.select("main_edition", "edition_variations", "variation").orderBy(*order, "variation")
    return (
        detail.groupBy("main_edition", "edition_variations")
        .agg(F.array_sort(F.collect_list("variation")).alias("variations"))
        .orderBy(*order)
    )


def aacid_sources(df: DataFrame) -> DataFrame:
    """Q14. Container ids per source with the earliest and latest timestamp text.

    An id without separators has the empty source and is kept.
    """
    ids = df.select(F.explode(V.json_strings(unified("identifiers_unified_aacid"))).alias("aacid"))
    parts = ids.filter(F.col("aacid").isNotNull()).select(
        F.split_part("aacid", F.lit("__"), F.lit(2)).alias("source_type"),
        F.split_part("aacid", F.lit("__"), F.lit(3)).alias("stamp"),
    )
    stats = parts.groupBy("source_type").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("stamp").alias("earliest_record"),
        F.max("stamp").alias("latest_record"),
    )
    return ranked(stats, "count", ["source_type"])


def language_counts(df: DataFrame) -> DataFrame:
    """Records per first language code; NULL and the empty list are left out."""
    codes = F.col(unified("most_likely_language_codes"))
    known = df.filter(codes.isNotNull() & (codes != "[]")).select(V.first_language(codes).alias("language"))
    return count_by(known, "language")


def top_languages(df: DataFrame, limit: int = 10) -> DataFrame:
    """Q15. Most frequent languages."""
    return ranked(language_counts(df), "count", ["language"], limit)


def search_text_lengths(df: DataFrame, min_count: int = 100) -> DataFrame:
    """Q16. Length of the search text in code points by content type."""
    text, kind = F.col(search("search_text")), F.col(unified("content_type_best"))
    measured = df.filter(text.isNotNull() & kind.isNotNull()).select(
        kind.alias("content_type"), V.text_length(text).alias("n")
    )
    stats = measured.groupBy("content_type").agg(
        F.count(F.lit(1)).alias("total_records"),
        *number_summary("n", "avg_text_length", "min_length", "max_length"),
    )
    return ranked(stats.filter(F.col("total_records") > min_count), "avg_text_length", ["content_type"])


def download_availability(df: DataFrame, min_count: int = 100) -> DataFrame:
    """Q17. Download options by content type; a flag that is no integer is an error (ANSI cast)."""
    flags = {
        "aa_downloads": "has_aa_downloads",
        "exclusive_downloads": "has_aa_exclusive_downloads",
        "torrent_available": "has_torrent_paths",
        "scidb_available": "has_scidb",
    }
    flagged = df.select(
        F.col(unified("content_type_best")).alias("content_type"),
        *[F.col(unified(c)).cast("int").alias(name) for name, c in flags.items()],
    )
    stats = flagged.groupBy("content_type").agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(name) == 1).alias(name) for name in flags],
    )
    return ranked(stats.filter(F.col("total_records") > min_count), "total_records", ["content_type"])


def one_record(df: DataFrame, stable: bool = True) -> DataFrame:
    """Q18. One complete record.

    Stable means the one with the smallest id, so that reruns agree: the id column alone is read to find it,
    and the equality then lets Parquet skip all other row groups. Otherwise the first row found will do.
    """
    if not stable or "_id" not in df.columns:
        return df.limit(1)
    return df.filter(F.col("_id") == df.agg(F.min("_id")).scalar()).limit(1)


def column_listing(df: DataFrame) -> DataFrame:
    """Q18. Name, type and position of every column of a table."""
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "column string, type string, position int")


def unreadable_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q18. Texts per list column, and how many of them are no JSON list; the list queries raise an error at those."""
    counts = [F.struct(F.lit(c).alias("column"), F.count(F.col(c)).alias("n_texts"),
                       F.count_if(V.unreadable_list(c)).alias("n_unreadable")) for c in columns]
    return df.agg(F.array(*counts).alias("__all")).select(F.inline("__all"))
