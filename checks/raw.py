"""Raw JSON Lines derived from ``documents``, once in Spark and once in SQL.

Six datasets by source; the fields a record carries vary with its id, so that some paths are common, some rare
and some tied to one dataset. Every tenth line is damaged by losing its last character.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.records import documents

_KIND = "cast(substr(source, 4) as int) % 6"
_DATASET = (
    f"case {_KIND} when 0 then 'records' when 1 then 'metadata' when 2 then 'journals' when 3 then 'digital_lending'"
    " when 4 then 'aac_duxiu_records' else 'aac_zlib3_records' end"
)
_FILE = (
    f"case {_KIND} when 0 then concat('aarecords__', cast(doc_id % 8 as string), '.json.gz')"
    f" when 1 then concat('aarecords_metadata__', cast(doc_id % 8 as string), '.json.gz')"
    f" when 2 then concat('aarecords_journals__', cast(doc_id % 8 as string), '.json.gz')"
    f" when 3 then concat('aarecords_digital_lending__', cast(doc_id % 8 as string), '.json.gz')"
    f" when 4 then concat('public_meta__aacid__duxiu_records__2024010', cast(doc_id % 8 as string),"
    " '.jsonl.seekable.zst')"
    f" else concat('public_meta__aacid__zlib3_records__2024010', cast(doc_id % 8 as string), '.jsonl.zst') end"
)
_SEARCH_LINE = (
    "concat('{\"_index\":\"aarecords__', cast(doc_id % 8 as string), '\",\"_id\":\"md5:', md5(cast(doc_id as string)),"
    " '\",\"_score\":', cast(doc_id % 100 as string), ',\"_source\":{\"file_unified_data\":{\"title_best\":', quoted,"
    " ',\"author_best\":\"author ', cast(doc_id % 37 as string), '\"',"
    " case when doc_id % 3 = 0 then ',\"year_best\":\"1999\"' when doc_id % 3 = 1 then ',\"year_best\":null' else '' end,"
    " ',\"content_type_best\":\"', source, '\",\"filesize_best\":', cast(n_chars * 1024 as string),"
    f" case when {_KIND} = 2 then concat(',\"journal\":{{\"issn\":[\"1234-', cast(doc_id % 10 as string),"
    " '\"],\"volume\":{\"no\":', cast(doc_id % 7 as string), '}}') else '' end,"
    f" case when {_KIND} = 3 and doc_id % 2 = 0 then ',\"lending\":[[{{\"until\":\"2024\"}},{{\"late\":1}}]]' else '' end,"
    " ',\"classifications_unified\":{\"oclc_holdings\":[\"', cast(doc_id % 3 as string), '\"]',"
    " case when doc_id % 13 = 0 then ',\"seldom\":{}' else '' end, '},\"editions\":[{\"year\":', cast(doc_id % 50 as string),"
    " ',\"tags\":[\"x\"]},{\"second\":2}]},\"search_only_fields\":{\"search_text\":', quoted, ',\"search_year\":\"',"
    " cast(1900 + doc_id % 120 as string), '\"}}}')"
)
_AAC_LINE = (
    f"concat('{{\"aacid\":\"aacid__', case when {_KIND} = 4 then 'duxiu_records' else 'zlib3_records' end,"
    " '__20240101T000000Z__', cast(doc_id as string), '\",\"metadata\":{\"title\":', quoted, ',\"pages\":',"
    " cast(n_chars as string), case when doc_id % 2 = 0 then ',\"nested\":[[{\"deep\":1}]],\"a\":{\"b_c\":1}' else '' end,"
    f" ',\"a_b\":{{\"c\":2}}', case when {_KIND} = 5 then ',\"isbn\":[\"978\"]' else '' end, '}},\"data_folder\":\"f\"}}')"
)


def _select(quoted: str) -> list[tuple[str, str]]:
    whole = f"case when {_KIND} < 4 then {_SEARCH_LINE} else {_AAC_LINE} end".replace("quoted", quoted)
    return [
        ("doc_id", "doc_id"),
        ("record_key", "md5(cast(doc_id as string))"),
        ("dataset", _DATASET),
        ("file_name", _FILE),
        ("whole", whole),
    ]


def raw_lines(spark: SparkSession, sf_dir: str, damage: bool = True) -> DataFrame:
    """``doc_id, record_key, dataset, file_name, file_path, value`` in Spark; ``damage`` breaks some lines."""
    # to_json of a one-element array, without the brackets, is the quoted and escaped text
    boxed = documents(spark, sf_dir, heavy=True).withColumn("quoted", F.expr("to_json(array(text))"))
    texts = boxed.withColumn("quoted", F.expr("substr(quoted, 2, length(quoted) - 2)"))
    rows = texts.selectExpr(*[f"{e} AS {n}" for n, e in _select("quoted")])
    damaged = F.expr("case when doc_id % 10 = 0 then substr(whole, 1, length(whole) - 1) else whole end")
    return rows.select("doc_id", "record_key", "dataset", "file_name", F.col("file_name").alias("file_path"),
                       (damaged if damage else F.col("whole")).alias("value"))


def raw_sql() -> str:
    """The same rows as common table expressions ``built`` (whole lines), ``raw`` (some
    damaged) and ``valid`` (those that parse, as ``j``)."""
    columns = ",\n  ".join(f"{e} AS {n}" for n, e in _select("to_json(text)::VARCHAR"))
    return f"""WITH built AS (SELECT
  {columns}
FROM documents),
raw AS (SELECT doc_id, record_key, dataset, file_name, file_name AS file_path,
  CASE WHEN doc_id % 10 = 0 THEN substr(whole, 1, length(whole) - 1) ELSE whole END AS value FROM built),
valid AS (SELECT doc_id, record_key, dataset, file_name, value::JSON AS j FROM raw WHERE json_valid(value))"""
