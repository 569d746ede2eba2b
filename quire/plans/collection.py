"""Reports over shredded collections that describe a dataset as a whole.

Same conventions as :mod:`quire.plans.search_index`: a shredded table in, a lazy DataFrame out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import values as V
from quire.functions.columns import search, unified
from quire.operators.summaries import compute_once, count_by, quantiles, ranked, with_share
from quire.plans.search_index import access_types, language_counts

SIZE_EDGES_MB = (1, 5, 10, 50, 100, 500)
STOP_WORDS = ("a", "an", "and", "by", "for", "from", "in", "of", "on", "or", "the", "to", "with")
# A title word list longer than this is no display list; the sort then runs over all tasks as usual.
TITLE_WORDS = 50


def content_types(df: DataFrame) -> DataFrame:
    """A01. Records and share per content type."""
    kinds = df.select(F.col(unified("content_type_best")).alias("content_type"))
    return ranked(with_share(count_by(kinds, "content_type")), "count", ["content_type"])


def _with_year(df: DataFrame, *others) -> DataFrame:
    years = compute_once(df, V.try_int(search("search_year")).alias("publish_year"), *others)
    return years.filter(F.col("publish_year").isNotNull())


def year_histogram(df: DataFrame, width: int = 1) -> DataFrame:
    """A02. Records per bin of ``width`` years, named by the first year of the bin."""
    first = (F.floor(F.col("publish_year") / width) * width).cast("int")
    return count_by(_with_year(df).select(first.alias("year_from")), "year_from").orderBy("year_from")


def languages(df: DataFrame) -> DataFrame:
    """A03. All languages with their share."""
    return ranked(with_share(language_counts(df)), "count", ["language"])


def size_distribution(df: DataFrame, edges_mb: Sequence[float] = SIZE_EDGES_MB) -> DataFrame:
    """A04. Records per file-size class; class ``i`` starts at the ``i``-th edge, class 0 below the first."""
    sizes = compute_once(df, V.size_mb(unified("filesize_best")).alias("mb")).filter(F.col("mb").isNotNull())
    klass = reduce(lambda acc, e: acc + F.when(F.col("mb") >= float(e), 1).otherwise(0), edges_mb, F.lit(0))
    labels = F.array(*[F.lit(float(e)) for e in edges_mb])
    counts = with_share(count_by(sizes.select(klass.alias("size_class")), "size_class"))
    return counts.select(
        "size_class",
        F.get(labels, F.col("size_class") - 1).alias("from_mb"),
        F.get(labels, F.col("size_class")).alias("below_mb"),
        "count",
        "percentage",
    ).orderBy("size_class")


def size_quantiles(df: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75, 0.95, 0.99), exact: bool = True,
                   accuracy: int = 10_000) -> DataFrame:
    """A04. File-size quantiles in MiB, one row each; ``exact=False`` takes one pass with a bounded error."""
    sizes = compute_once(df, V.size_mb(unified("filesize_best")).alias("size_mb")).filter(F.col("size_mb").isNotNull())
    if exact:
        return quantiles(sizes, "size_mb", shares)
    found = sizes.agg(F.percentile_approx("size_mb", list(shares), accuracy).alias("q"))
    named = F.arrays_zip(F.array(*[F.lit(float(s)) for s in shares]).alias("share"), F.col("q").alias("size_mb"))
    return found.select(F.inline(named)).toDF("share", "size_mb")


def top_publishers(df: DataFrame, limit: int = 20) -> DataFrame:
    """A05. Publishers with most records."""
    name = F.col(unified("publisher_best"))
    return ranked(count_by(df.filter(name.isNotNull()).select(name.alias("publisher")), "publisher"), "count",
                  ["publisher"], limit)


def extensions(df: DataFrame) -> DataFrame:
    """A06. Records per file extension, regardless of case."""
    ext = F.col(unified("extension_best"))
    kinds = df.filter(ext.isNotNull()).select(F.lower(ext).alias("extension"))
    return ranked(with_share(count_by(kinds, "extension")), "count", ["extension"])


def access_type_shares(df: DataFrame) -> DataFrame:
    """A07. Access types with their share."""
    return access_types(df)


def years_by_content_type(df: DataFrame) -> DataFrame:
    """A08. Records per year and content type."""
    rows = _with_year(df, F.col(unified("content_type_best")).alias("content_type"))
    return count_by(rows, "publish_year", "content_type").orderBy("publish_year", "content_type")


def top_authors(df: DataFrame, limit: int = 20) -> DataFrame:
    """A09. Authors with most records."""
    name = F.col(unified("author_best"))
    return ranked(count_by(df.filter(name.isNotNull()).select(name.alias("author")), "author"), "count", ["author"],
                  limit)


def languages_by_year(df: DataFrame) -> DataFrame:
    """A10. Records per year and language, with the language's share of the year."""
    codes = F.col(unified("most_likely_language_codes"))
    rows = _with_year(df, codes.alias("codes")).filter(F.col("codes").isNotNull() & (F.col("codes") != "[]"))
    counts = count_by(rows.select("publish_year", V.first_language("codes").alias("language")),
                      "publish_year", "language")
    # the window sees one row per year and language, not the records
    total = F.sum("count").over(Window.partitionBy("publish_year"))
    share = V.round2(F.col("count").cast("double") * 100.0 / total)
    return counts.withColumn("year_percentage", share).orderBy("publish_year", "language")


def torrent_availability(df: DataFrame) -> DataFrame:
    """A11. Records with and without a torrent path per content type, with the share that has one."""
    rows = df.select(
        F.col(unified("content_type_best")).alias("content_type"),
        F.col(unified("has_torrent_paths")).cast("int").alias("flag"),
    )
    stats = rows.groupBy("content_type").agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(F.col("flag") == 1).alias("with_torrent")
    )
    share = V.round2(F.col("with_torrent").cast("double") * 100.0 / F.col("total_records"))
    return ranked(stats.withColumn("torrent_percentage", share), "total_records", ["content_type"])


def title_words(df: DataFrame, limit: int = TITLE_WORDS, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """A12. Most frequent words of titles: runs of letters and digits, lower case, without stop words."""
    title = F.col(unified("title_best"))
    words = df.filter(title.isNotNull()).select(
        F.explode(F.split(F.lower(title), r"[^\p{L}\p{N}]+")).alias("word")
    )
    kept = words.filter((F.col("word") != "") & ~F.col("word").isin(*stop_words))
    return ranked(count_by(kept, "word"), "count", ["word"], limit)


def _year_and_size(df: DataFrame) -> DataFrame:
    rows = _with_year(df, V.size_mb(unified("filesize_best")).cast("double").alias("mb"))
    return rows.filter(F.col("mb").isNotNull())


def year_size_correlation(df: DataFrame) -> DataFrame:
    """A13. Pearson correlation of year and file size over records that have both."""
    rows = _year_and_size(df)
    return rows.agg(
        F.count(F.lit(1)).alias("n_records"), F.corr(F.col("publish_year").cast("double"), "mb").alias("correlation")
    )


def size_by_year(df: DataFrame) -> DataFrame:
    """A13. Mean file size per year."""
    return (
        _year_and_size(df)
        .groupBy("publish_year")
        .agg(F.count(F.lit(1)).alias("count"), V.round2(F.avg("mb")).alias("avg_size_mb"))
        .orderBy("publish_year")
    )


def extensions_by_content_type(df: DataFrame) -> DataFrame:
    """A14. Records per extension and content type."""
    ext = F.col(unified("extension_best"))
    rows = df.filter(ext.isNotNull()).select(
        F.lower(ext).alias("extension"), F.col(unified("content_type_best")).alias("content_type")
    )
    return ranked(count_by(rows, "extension", "content_type"), "count", ["extension", "content_type"])


def combine(tables: dict[str, DataFrame]) -> DataFrame:
    """Several shredded tables as one, with their name in ``dataset``; columns match by name."""
    named = [t.withColumn("dataset", F.lit(name)) for name, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def dataset_overview(df: DataFrame, columns: Sequence[str] = ("title_best", "author_best", "year_best",
                                                              "filesize_best")) -> DataFrame:
    """A15. Per dataset: records, distinct ids and the percentage of records missing each column.

    Ids are distinct-counted on (dataset, id), so a dataset that holds most rows spreads over all tasks.
    """
    missing = [
        V.round2(F.count_if(F.col(unified(c)).isNull()).cast("double") * 100.0 / F.count(F.lit(1))).alias(f"{c}_null_pct")
        for c in columns
    ]
    return (
        df.groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("_id").alias("distinct_ids"), *missing)
        .orderBy("dataset")
    )
