"""Q01-Q18 over the ``records`` view, with the SQL each must agree with."""

from __future__ import annotations

from checks.records import S, U, records, records_sql
from quire.plans import search_index as q

_BOOK_SQL = f"""{U}_original_filename_best AS filename, {U}_title_best AS title, {U}_author_best AS author,
  {U}_publisher_best AS publisher, {U}_year_best AS year, {U}_filesize_best AS filesize,
  {U}_extension_best AS extension, {U}_cover_url_best AS cover_url"""

ID = "md5:c4ca4238a0b923820dcc509a6f75849b"  # md5 of '1'


def _length_sql(column: str, count: str, mean: str, where: str) -> str:
    return f"""SELECT {U}_content_type_best AS content_type, count(*) AS {count},
  round(avg(length({column})), 2) AS {mean}, min(length({column})) AS min_length, max(length({column})) AS max_length
FROM records WHERE {where} GROUP BY 1 HAVING count(*) > 5"""


# list columns of the queries, and one of another kind
_LISTS = [f"{S}_search_access_types", f"{U}_edition_varia_additional", f"{U}_identifiers_unified_aacid",
          f"{U}_most_likely_language_codes"]


def _over_records(fn, **params):
    return lambda spark, sf_dir: fn(records(spark, sf_dir), **params)


QUERIES = {
    "Q01_cover_sources": _over_records(q.cover_sources),
    "Q02_filename_search": _over_records(q.filename_search, text="src1_%pdf", limit=10),
    "Q03_id_lookup": _over_records(q.id_lookup, record_id=ID),
    "Q04_file_sizes": _over_records(q.file_sizes, min_count=5),
    "Q05_classifications": _over_records(q.classifications, min_count=1),
    "Q06_access_types": _over_records(q.access_types),
    "Q07_rank_scores": _over_records(q.rank_scores, min_count=5),
    "Q08_title_lengths": _over_records(q.title_lengths, min_count=5),
    "Q09_publication_years": _over_records(q.publication_years),
    "Q10_books_by_author": _over_records(q.books_by_author, author="author 5"),
    "Q11_rare_books": _over_records(q.rare_books),
    "Q11_rare_books_whole_object": lambda spark, sf_dir: q.rare_books(records(spark, sf_dir).select(U)),
    "Q12_books_by_decade": _over_records(q.books_by_decade),
    "Q12_books_by_decade_float": _over_records(q.books_by_decade, exact_reference=True),
    "Q13_edition_variations": _over_records(q.edition_variations, as_rows=False),
    "Q13_edition_variation_rows": _over_records(q.edition_variations),
    "Q14_aacid_sources": _over_records(q.aacid_sources),
    "Q15_top_languages": _over_records(q.top_languages),
    "Q16_search_text_lengths": _over_records(q.search_text_lengths, min_count=5),
    "Q17_download_availability": _over_records(q.download_availability, min_count=5),
    "Q18_one_record": _over_records(q.one_record),
    "Q18_column_listing": _over_records(q.column_listing),
    "Q18_unreadable_lists": _over_records(q.unreadable_lists, columns=_LISTS),
}

_PAIRS = f"""pairs AS (SELECT DISTINCT {U}_edition_varia_best AS main_edition, variation FROM (
  SELECT {U}_edition_varia_best, unnest(from_json({U}_edition_varia_additional, '["VARCHAR"]')) AS variation FROM records
  WHERE {U}_edition_varia_best IS NOT NULL) WHERE variation IS NOT NULL),
winners AS (SELECT main_edition, count(*) AS edition_variations FROM pairs GROUP BY 1 HAVING count(*) > 1
  ORDER BY edition_variations DESC, main_edition LIMIT 10)
"""

_TAIL = {
    "Q01_cover_sources": f"""SELECT CASE WHEN contains({U}_cover_url_best, 'archive.org') THEN 'Internet Archive'
  WHEN contains({U}_cover_url_best, 'openlibrary.org') THEN 'Open Library'
  WHEN contains({U}_cover_url_best, 'isbndb.com') THEN 'ISBNdb' ELSE 'Other' END AS cover_source, count(*) AS count
FROM records WHERE {U}_cover_url_best IS NOT NULL GROUP BY 1""",
    "Q02_filename_search": f"""SELECT {_BOOK_SQL} FROM records
WHERE {U}_original_filename_best LIKE '%src1_%pdf%' ORDER BY {U}_original_filename_best, _id LIMIT 10""",
    "Q03_id_lookup": f"""SELECT _id AS id, {_BOOK_SQL} FROM records WHERE _id = '{ID}' ORDER BY 2, 3 LIMIT 10""",
    "Q04_file_sizes": f"""SELECT {U}_content_type_best AS content_type, count(*) AS count,
  round(avg(mb), 2) AS avg_size_mb, round(min(mb)::DOUBLE, 2) AS min_size_mb, round(max(mb)::DOUBLE, 2) AS max_size_mb
FROM (SELECT *, try_cast({U}_filesize_best AS FLOAT) / 1048576 AS mb FROM records) WHERE {U}_filesize_best IS NOT NULL
GROUP BY 1 HAVING count(*) > 5""",
    "Q05_classifications": f"""SELECT c ->> '$.ia_collection[0]' AS collection, c ->> '$.oclc_holdings[0]' AS holdings,
  c ->> '$.content_type[0]' AS content_type, count(*) AS count
FROM (SELECT {U}_classifications_unified AS c FROM records) WHERE (c ->> '$.ia_collection[0]') IS NOT NULL
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "Q06_access_types": f"""SELECT access_type, count(*) AS count,
  round(count(*) * 100.0 / (sum(count(*)) OVER ()), 2) AS percentage
FROM (SELECT unnest(from_json({S}_search_access_types, '["VARCHAR"]')) AS access_type FROM records) GROUP BY 1""",
    "Q07_rank_scores": f"""SELECT {U}_content_type_best AS content_type, count(*) AS count,
  round(avg({S}_search_score_base_rank::FLOAT), 2) AS avg_rank, min({S}_search_score_base_rank::FLOAT) AS min_rank,
  max({S}_search_score_base_rank::FLOAT) AS max_rank
FROM records WHERE {S}_search_score_base_rank IS NOT NULL GROUP BY 1 HAVING count(*) > 5""",
    "Q08_title_lengths": _length_sql(f"{U}_title_best", "count", "avg_length", f"{U}_title_best IS NOT NULL"),
    "Q09_publication_years": f"""SELECT try_cast({S}_search_year AS INTEGER) AS publish_year, count(*) AS count
FROM records WHERE try_cast({S}_search_year AS INTEGER) BETWEEN 1900 AND 2025 GROUP BY 1""",
    "Q10_books_by_author": f"""SELECT {U}_title_best AS title, {U}_author_best AS author, {U}_publisher_best AS publisher,
  try_cast({U}_year_best AS INTEGER) AS publish_year, {U}_cover_url_best AS cover_url
FROM records WHERE {U}_author_best = 'author 5'""",
    "Q11_rare_books": f"""SELECT CASE WHEN h IS NOT NULL AND json_array_length(h) > 0 AND NOT json_contains(h, '"many"')
  THEN 'Rare' ELSE 'Not Rare' END AS rarity, count(*) AS count
FROM (SELECT json_extract({U}, '$.classifications_unified.oclc_holdings') AS h FROM records) GROUP BY 1""",
    "Q12_books_by_decade": f"""SELECT (y // 10 * 10)::INTEGER AS decade, count(*) AS count
FROM (SELECT try_cast({S}_search_year AS INTEGER) AS y FROM records) WHERE y IS NOT NULL GROUP BY 1""",
    "Q12_books_by_decade_float": f"""SELECT (y / 10) * 10 AS decade, count(*) AS count
FROM (SELECT try_cast({S}_search_year AS INTEGER) AS y FROM records) WHERE y IS NOT NULL GROUP BY 1""",
    "Q13_edition_variations": """SELECT main_edition, edition_variations, list_sort(list(variation)) AS variations
FROM pairs JOIN winners USING (main_edition) GROUP BY 1, 2""",
    "Q13_edition_variation_rows": """SELECT main_edition, edition_variations, variation
FROM pairs JOIN winners USING (main_edition)""",
    "Q14_aacid_sources": f"""SELECT split_part(a, '__', 2) AS source_type, count(*) AS count,
  min(split_part(a, '__', 3)) AS earliest_record, max(split_part(a, '__', 3)) AS latest_record
FROM (SELECT unnest(from_json({U}_identifiers_unified_aacid, '["VARCHAR"]')) AS a FROM records)
WHERE a IS NOT NULL GROUP BY 1""",
    "Q15_top_languages": f"""SELECT CASE WHEN codes LIKE '[%]' THEN regexp_extract(codes, '^\\["([^"]*)"', 1) ELSE codes END
  AS language, count(*) AS count
FROM (SELECT {U}_most_likely_language_codes AS codes FROM records) WHERE codes IS NOT NULL AND codes <> '[]'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "Q16_search_text_lengths": _length_sql(
        f"{S}_search_text",
        "total_records",
        "avg_text_length",
        f"{S}_search_text IS NOT NULL AND {U}_content_type_best IS NOT NULL",
    ),
    "Q17_download_availability": f"""SELECT {U}_content_type_best AS content_type, count(*) AS total_records,
  count(*) FILTER ({U}_has_aa_downloads::INTEGER = 1) AS aa_downloads,
  count(*) FILTER ({U}_has_aa_exclusive_downloads::INTEGER = 1) AS exclusive_downloads,
  count(*) FILTER ({U}_has_torrent_paths::INTEGER = 1) AS torrent_available,
  count(*) FILTER ({U}_has_scidb::INTEGER = 1) AS scidb_available
FROM records GROUP BY 1 HAVING count(*) > 5""",
    "Q18_one_record": "SELECT * FROM records ORDER BY _id LIMIT 1",
    "Q18_column_listing": """SELECT column_name AS "column", CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END
  AS type, row_number() OVER ()::INTEGER AS position FROM (DESCRIBE SELECT * FROM records)""",
    "Q18_unreadable_lists": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NOT NULL) AS n_texts,
  count(*) FILTER ("{c}" IS NOT NULL AND (NOT json_valid("{c}") OR json_type(CASE WHEN json_valid("{c}") THEN "{c}" END) <> 'ARRAY')) AS n_unreadable
FROM records""" for c in _LISTS),
}
_TAIL["Q11_rare_books_whole_object"] = _TAIL["Q11_rare_books"]


def _sql(name: str) -> str:
    head = records_sql().rstrip()
    if name.startswith("Q13"):
        return f"{head},\n{_PAIRS}{_TAIL[name]}"
    return f"{head}\n{_TAIL[name]}"


SQL = {name: _sql(name) for name in _TAIL}
