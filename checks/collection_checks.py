"""A01-A15 over the ``records`` view, with the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.records import S, U, records, records_sql
from quire.plans import collection as c


def _over_records(fn, **params):
    return lambda spark, sf_dir: fn(records(spark, sf_dir), **params)


def _overview(spark, sf_dir):
    one = records(spark, sf_dir).drop("dataset")
    return c.dataset_overview(c.combine({"whole": one, "untitled": one.drop(f"{U}_filesize_best")}))


QUERIES = {
    "A01_content_types": _over_records(c.content_types),
    "A02_year_histogram": _over_records(c.year_histogram, width=5),
    "A03_languages": _over_records(c.languages),
    "A04_size_distribution": _over_records(c.size_distribution),
    "A04_size_quantiles": _over_records(c.size_quantiles),
    "A05_top_publishers": _over_records(c.top_publishers, limit=7),
    "A06_extensions": _over_records(c.extensions),
    "A07_access_types": _over_records(c.access_type_shares),
    "A08_years_by_content_type": _over_records(c.years_by_content_type),
    "A09_top_authors": _over_records(c.top_authors, limit=10),
    "A10_languages_by_year": _over_records(c.languages_by_year),
    "A11_torrent_availability": _over_records(c.torrent_availability),
    "A12_title_words": lambda spark, sf_dir: c.title_words(records(spark, sf_dir, heavy=True)),
    "A13_year_size_correlation": lambda spark, sf_dir: c.year_size_correlation(records(spark, sf_dir)).withColumn(
        "correlation", F.round("correlation", 6)
    ),
    "A13_size_by_year": _over_records(c.size_by_year),
    "A14_extensions_by_content_type": _over_records(c.extensions_by_content_type),
    "A15_dataset_overview": lambda spark, sf_dir: c.dataset_overview(records(spark, sf_dir)),
    "A15_combined_overview": _overview,
}

_YEAR = f"try_cast({S}_search_year AS INTEGER)"
_MB = f"(try_cast({U}_filesize_best AS FLOAT) / 1048576)"
_LANGUAGE = f"""CASE WHEN {U}_most_likely_language_codes LIKE '[%]'
  THEN regexp_extract({U}_most_likely_language_codes, '^\\["([^"]*)"', 1) ELSE {U}_most_likely_language_codes END"""
_KNOWN = f"{U}_most_likely_language_codes IS NOT NULL AND {U}_most_likely_language_codes <> '[]'"
_SHARE = "round(count(*) * 100.0 / (sum(count(*)) OVER ()), 2) AS percentage"
_NULLS = ", ".join(
    f"round(count(*) FILTER ({U}_{n} IS NULL) * 100.0 / count(*), 2) AS {n}_null_pct"
    for n in ("title_best", "author_best", "year_best", "filesize_best")
)
_CLASS = " + ".join(f"({_MB} >= {e})::INTEGER" for e in c.SIZE_EDGES_MB)
_EDGES = ", ".join(f"{e}.0::DOUBLE" for e in c.SIZE_EDGES_MB)
_STOP = ", ".join(f"'{w}'" for w in c.STOP_WORDS)

_TAIL = {
    "A01_content_types": f"SELECT {U}_content_type_best AS content_type, count(*) AS count, {_SHARE} FROM records GROUP BY 1",
    "A02_year_histogram": f"""SELECT (y // 5 * 5)::INTEGER AS year_from, count(*) AS count
FROM (SELECT {_YEAR} AS y FROM records) WHERE y IS NOT NULL GROUP BY 1""",
    "A03_languages": f"SELECT {_LANGUAGE} AS language, count(*) AS count, {_SHARE} FROM records WHERE {_KNOWN} GROUP BY 1",
    "A04_size_distribution": f"""SELECT k AS size_class, list_extract([{_EDGES}], k) AS from_mb,
  list_extract([{_EDGES}], k + 1) AS below_mb, count(*) AS count, {_SHARE}
FROM (SELECT {_CLASS} AS k FROM records) WHERE k IS NOT NULL GROUP BY k""".replace(
        "list_extract([" + _EDGES + "], k) AS", "CASE WHEN k > 0 THEN list_extract([" + _EDGES + "], k) END AS"
    ),
    "A04_size_quantiles": f"""SELECT unnest([0.25, 0.5, 0.75, 0.95, 0.99]::DOUBLE[]) AS share,
  unnest(quantile_disc({_MB}, [0.25, 0.5, 0.75, 0.95, 0.99])) AS size_mb FROM records""",
    "A05_top_publishers": f"""SELECT {U}_publisher_best AS publisher, count(*) AS count FROM records
WHERE {U}_publisher_best IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7""",
    "A06_extensions": f"""SELECT lower({U}_extension_best) AS extension, count(*) AS count, {_SHARE} FROM records
WHERE {U}_extension_best IS NOT NULL GROUP BY 1""",
    "A07_access_types": f"""SELECT access_type, count(*) AS count, {_SHARE}
FROM (SELECT unnest(from_json({S}_search_access_types, '["VARCHAR"]')) AS access_type FROM records) GROUP BY 1""",
    "A08_years_by_content_type": f"""SELECT {_YEAR} AS publish_year, {U}_content_type_best AS content_type, count(*) AS count
FROM records WHERE {_YEAR} IS NOT NULL GROUP BY 1, 2""",
    "A09_top_authors": f"""SELECT {U}_author_best AS author, count(*) AS count FROM records
WHERE {U}_author_best IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "A10_languages_by_year": f"""SELECT {_YEAR} AS publish_year, {_LANGUAGE} AS language, count(*) AS count,
  round(count(*) * 100.0 / (sum(count(*)) OVER (PARTITION BY {_YEAR})), 2) AS year_percentage
FROM records WHERE {_KNOWN} AND {_YEAR} IS NOT NULL GROUP BY 1, 2""",
    "A11_torrent_availability": f"""SELECT {U}_content_type_best AS content_type, count(*) AS total_records,
  count(*) FILTER ({U}_has_torrent_paths::INTEGER = 1) AS with_torrent,
  round(count(*) FILTER ({U}_has_torrent_paths::INTEGER = 1) * 100.0 / count(*), 2) AS torrent_percentage
FROM records GROUP BY 1""",
    "A12_title_words": f"""SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower({U}_title_best), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM records)
WHERE word <> '' AND word NOT IN ({_STOP}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {c.TITLE_WORDS}""",
    "A13_year_size_correlation": f"""SELECT count(*) AS n_records, round(corr(y, mb), 6) AS correlation
FROM (SELECT {_YEAR}::DOUBLE AS y, {_MB}::DOUBLE AS mb FROM records) WHERE y IS NOT NULL AND mb IS NOT NULL""",
    "A13_size_by_year": f"""SELECT y AS publish_year, count(*) AS count, round(avg(mb), 2) AS avg_size_mb
FROM (SELECT {_YEAR} AS y, {_MB}::DOUBLE AS mb FROM records) WHERE y IS NOT NULL AND mb IS NOT NULL GROUP BY 1""",
    "A14_extensions_by_content_type": f"""SELECT lower({U}_extension_best) AS extension,
  {U}_content_type_best AS content_type, count(*) AS count FROM records
WHERE {U}_extension_best IS NOT NULL GROUP BY 1, 2""",
    "A15_dataset_overview": f"""SELECT dataset, count(*) AS n_records, count(DISTINCT _id) AS distinct_ids, {_NULLS}
FROM records GROUP BY 1""",
    "A15_combined_overview": f"""SELECT dataset, count(*) AS n_records, count(DISTINCT _id) AS distinct_ids, {_NULLS}
FROM (SELECT * REPLACE ('whole' AS dataset) FROM records UNION ALL BY NAME
  SELECT * EXCLUDE ({U}_filesize_best) REPLACE ('untitled' AS dataset) FROM records) GROUP BY 1""",
}

SQL = {name: f"{records_sql().rstrip()}\n{tail}" for name, tail in _TAIL.items()}
