"""The shredded search-index table, derived from ``documents`` once in Spark and once in SQL.

Both derivations use the same plain text operations, so the two engines see the same bytes. All rows and
whole texts are used; the moduli only decide which variant of a field a record carries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.functions.columns import SEARCH, UNIFIED
from quire.sources.readers import spread

U, S = UNIFIED, SEARCH

# column -> expression valid in both engines (d = doc_id as bigint)
_SHARED = {
    "_index": "concat('aarecords__', cast(doc_id % 8 as string))",
    "_id": "concat('md5:', md5(cast(doc_id as string)))",
    f"{U}_content_type_best": "case when doc_id % 29 = 0 then null else source end",
    f"{U}_title_best": "case when doc_id % 23 = 0 then null else text end",
    f"{U}_author_best": "concat('author ', cast(doc_id % 37 as string))",
    f"{U}_publisher_best": "case when doc_id % 12 = 0 then null else concat('pub ', cast(doc_id % 11 as string)) end",
    f"{U}_year_best": (
        "case when doc_id % 17 = 0 then null when doc_id % 19 = 0 then 'c1999' when doc_id % 43 = 0 then '1999.7'"
        " else cast(1890 + (doc_id * 7) % 140 as string) end"
    ),
    f"{U}_filesize_best": (
        "case when doc_id % 13 = 0 then null when doc_id % 31 = 0 then 'n/a'"
        " else cast(n_chars * 1024 as string) end"
    ),
    f"{U}_extension_best": (
        "case doc_id % 5 when 0 then 'pdf' when 1 then 'epub' when 2 then 'djvu' when 3 then 'PDF' else 'mobi' end"
    ),
    f"{U}_original_filename_best": (
        "concat(source, '_', cast(doc_id as string), case when doc_id % 3 = 0 then '.pdf' else '.epub' end)"
    ),
    f"{U}_cover_url_best": (
        "case doc_id % 6 when 0 then concat('https://covers.archive.org/b/', cast(doc_id as string))"
        " when 1 then concat('https://covers.openlibrary.org/b/', cast(doc_id as string))"
        " when 2 then concat('https://images.isbndb.com/covers/', cast(doc_id as string))"
        " when 3 then concat('https://example.net/archive.org/openlibrary.org/', cast(doc_id as string))"
        " when 4 then concat('https://example.net/', source) else null end"
    ),
    f"{U}_most_likely_language_codes": (
        "case doc_id % 7 when 0 then null when 1 then '[]' when 2 then concat('[\"', lang, '\",\"xx\"]')"
        " when 3 then concat('[', lang, ']') else lang end"
    ),
    f"{U}_classifications_unified": (
        "case when doc_id % 41 = 0 then null else concat('{\"ia_collection\":', case doc_id % 4 when 0 then 'null'"
        " when 1 then concat('[\"', source, '\",\"inlibrary\"]') when 2 then '[\"opensource\"]' else '[]' end,"
        " case doc_id % 9 when 0 then '' when 1 then ',\"oclc_holdings\":null' when 2 then ',\"oclc_holdings\":[]'"
        " when 3 then ',\"oclc_holdings\":[\"many\"]' when 4 then ',\"oclc_holdings\":[\"1\",\"many\"]'"
        " when 5 then ',\"oclc_holdings\":[[\"many\"],\"2\"]' when 6 then ',\"oclc_holdings\":[\"not many\"]'"
        " else concat(',\"oclc_holdings\":[\"', cast(doc_id % 3 as string), '\"]') end,"
        " ',\"content_type\":[\"', lang, '\"]}') end"
    ),
    f"{U}_edition_varia_best": (
        "case when doc_id % 10 = 9 then null when doc_id % 3 = 0 then '1st ed.' else concat('ed. ', source) end"
    ),
    f"{U}_edition_varia_additional": (
        "case doc_id % 8 when 0 then null when 1 then '[]' when 2 then '[null]'"
        " else concat('[\"', lang, ' ', cast(doc_id % 50 as string), '\",\"reprint ', cast(doc_id % 4 as string), '\"]') end"
    ),
    f"{U}_identifiers_unified_aacid": (
        "case doc_id % 6 when 0 then null when 1 then '[]' when 2 then '[\"plain\"]'"
        " else concat('[\"aacid__', source, '__', cast(20240101 + doc_id % 28 as string), 'T000000Z__',"
        " cast(doc_id as string), '\",\"aacid__zlib3_records__', cast(20230101 + doc_id % 28 as string), 'T000000Z__',"
        " cast(doc_id as string), '\"]') end"
    ),
    f"{U}_has_aa_downloads": "case when doc_id % 2 = 0 then '1' else '0' end",
    f"{U}_has_aa_exclusive_downloads": "case when doc_id % 5 = 0 then '1' else '0' end",
    f"{U}_has_torrent_paths": "case when doc_id % 11 = 0 then null when doc_id % 3 = 0 then '1' else '0' end",
    f"{U}_has_scidb": "case when doc_id % 50 = 0 then '1' else '0' end",
    f"{S}_search_access_types": (
        "case doc_id % 6 when 0 then null when 1 then '[]' when 2 then '[\"aa_download\",\"aa_download\"]'"
        " when 3 then '[\"external_download\"]' when 4 then '[\"aa_download\",\"torrents_available\"]'"
        " else concat('[\"aa_search_', lang, '\"]') end"
    ),
    f"{S}_search_score_base_rank": (
        "case when doc_id % 21 = 0 then null else cast(doc_id % 1000 as string) end"
    ),
    f"{S}_search_year": (
        "case when doc_id % 17 = 0 then null when doc_id % 19 = 0 then 'c1999' when doc_id % 47 = 0 then ' 2001 '"
        " else cast(1890 + (doc_id * 7) % 140 as string) end"
    ),
    f"{S}_search_text": (
        "case when doc_id % 53 = 0 then null else concat(text, ' author ', cast(doc_id % 37 as string)) end"
    ),
}

# the whole object as JSON text, of which only the classification part matters to the queries
_OBJECT = f"concat('{{\"classifications_unified\":', coalesce({_SHARED[U + '_classifications_unified']}, 'null'), '}}')"


_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """The documents table. ``heavy`` is for work that parses every text: when the table has fewer files than
    the cluster has slots, its rows are spread over all of them first."""
    df = spark.read.schema(_SCHEMA).parquet(f"{sf_dir}/documents.parquet")
    slots = spark.sparkContext.defaultParallelism
    return spread(df, slots) if heavy and len(df.inputFiles()) < slots else df


def records(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Shredded table in Spark."""
    columns = [f"{e} AS `{c}`" for c, e in _SHARED.items()]
    return documents(spark, sf_dir, heavy).selectExpr(
        *columns,
        "cast(doc_id % 100 as double) / 8 AS `_score`",
        f"{_OBJECT} AS `{U}`",
        "concat('set', cast(doc_id % 3 as string)) AS dataset",
    )


def records_sql() -> str:
    """The same table as a SQL common table expression ``records``."""
    columns = ",\n  ".join(f'{e} AS "{c}"' for c, e in _SHARED.items())
    return (
        f"WITH records AS (SELECT\n  {columns},\n  cast(doc_id % 100 as double) / 8 AS \"_score\",\n"
        f"  {_OBJECT} AS \"{U}\",\n  concat('set', cast(doc_id % 3 as string)) AS dataset\nFROM documents)\n"
    )
