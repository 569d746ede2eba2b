"""Profile and field selection (P01-P12, X03) over raw lines, with the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.raw import raw_lines, raw_sql
from quire.operators import fields as fl
from quire.operators import paths as pt
from quire.session import scratch_path
from quire.sources import sinks

RATE = 0.2

# first 32 bits of the record key's md5 as an integer, in Spark and in SQL


def _key_hash():
    return F.conv(F.substring("record_key", 1, 8), 16, 10).cast("bigint")


_KEY_HASH_SQL = "('0x' || substr(record_key, 1, 8))::BIGINT"


def _profile(spark, sf_dir, rate=1.0):
    lines = pt.sample_rows(raw_lines(spark, sf_dir), rate, on=_key_hash())
    return pt.profile(lines.select("dataset", "value"), rate)


def _sample_rows(spark, sf_dir):
    return pt.sample_rows(raw_lines(spark, sf_dir), RATE, on=_key_hash()).select("dataset", "doc_id")


def _sample_files(spark, sf_dir):
    files = raw_lines(spark, sf_dir).select("dataset", F.col("file_name").alias("path")).distinct()
    return pt.sample_files(files, RATE, on=F.md5("path"))


def _sample_files_by_size(spark, sf_dir):
    files = raw_lines(spark, sf_dir).groupBy("dataset", F.col("file_name").alias("path")).agg(
        F.sum(F.octet_length("value").cast("bigint") + 1).alias("length"))
    drawn = pt.sample_files_by_size(files, 0.5, on=F.md5("path"), start=0.37)
    return drawn.withColumn("weight", F.round("weight", 6))


def _paths_per_record(spark, sf_dir):
    found = pt.key_pointers(raw_lines(spark, sf_dir), keep=("record_key",))
    return found.filter(F.col("pointer") != "").groupBy("record_key").agg(F.count(F.lit(1)).alias("n_paths"))


def _totals(spark, sf_dir):
    return pt.record_totals(pt.count_paths(raw_lines(spark, sf_dir).select("dataset", "value")))


def _selected(spark, sf_dir, **thresholds):
    return fl.select_fields(_profile(spark, sf_dir), **thresholds)


def _stored(spark, sf_dir):
    """The profile as a stored table, for reports that use it more than once."""
    path = scratch_path(spark, "profile")
    sinks.write_report(_profile(spark, sf_dir), path)
    return spark.read.parquet(path)


def _shared(spark, sf_dir, group):
    profile = _stored(spark, sf_dir)
    return fl.shared_fields(fl.select_fields(profile), profile, group)


def _report_text(spark, sf_dir):
    """The report's lines as they lie in its files."""
    profile, path = _stored(spark, sf_dir), scratch_path(spark, "report")
    sinks.write_text_report(fl.field_report(profile, fl.select_fields(profile)), path)
    parts = F.split("value", "\t")
    names = ["section", "position", "presence_pct", "n_records", "total_records", "path", "column"]
    lines = spark.read.text(path).select("dataset", *[parts[i].alias(n) for i, n in enumerate(names)])
    return lines.withColumn("position", F.col("position").cast("int"))


def _document_round_trip(spark, sf_dir):
    """Write the selection document, read both parts back."""
    base = scratch_path(spark, "selection")
    profile = _stored(spark, sf_dir)
    document = fl.selection_document(profile, fl.select_fields(profile), "elasticsearchaux", "whole input")
    sinks.write_document(document, f"{base}/document")
    own = sinks.read_selection(spark, f"{base}/document").select("dataset", "path", "column")
    union = sinks.read_combined(spark, f"{base}/document", "elasticsearchaux").select(
        F.lit("combined").alias("dataset"), "path", "column"
    )
    return own.unionByName(union)


def _names_kept(spark, sf_dir):
    """Names of all selected fields after a run that knew only those of odd documents, which lack some paths."""
    lines = raw_lines(spark, sf_dir)
    early = pt.profile(lines.filter(F.col("doc_id") % 2 == 1).select("dataset", "value"))
    known = fl.column_registry(fl.select_fields(early), "elasticsearch")
    path = scratch_path(spark, "names")
    sinks.write_report(known, path)
    now = fl.select_fields(_profile(spark, sf_dir), known=spark.read.schema(known.schema).parquet(path))
    return now.select("dataset", "path", "column")


QUERIES = {
    "P01_sample_rows": _sample_rows,
    "P01_sample_files": _sample_files,
    "P01_sample_files_by_size": _sample_files_by_size,
    "P02_key_paths_per_record": _paths_per_record,
    "P03_path_counts": lambda s, d: _profile(s, d).select("dataset", "path", "n_records", "total_records", "n_unparsed"),
    "P03_record_totals": _totals,
    "P04_scaled_counts": lambda s, d: _profile(s, d, RATE).select(
        "dataset", "path", "sampled_n", "n_records", "total_records"
    ),
    "P05_selected_fields": lambda s, d: _selected(s, d).select("dataset", "path", "n_records", "total_records"),
    "P06_column_names": lambda s, d: fl.with_column_names(
        _profile(s, d).select("dataset", "path"), within=("dataset",)
    ),
    "P07_combined_aux": lambda s, d: fl.combined_fields(_selected(s, d), "elasticsearchaux").drop("pointer"),
    "P07_combined_aac": lambda s, d: fl.combined_fields(_selected(s, d), "aac").drop("pointer"),
    "P08_shared_aux": lambda s, d: _shared(s, d, "elasticsearchaux"),
    "P08_shared_aac": lambda s, d: _shared(s, d, "aac"),
    "P09_selected_report": lambda s, d: fl.selected_report(_selected(s, d)),
    "P10_presence_report": lambda s, d: fl.presence_report(_profile(s, d)),
    "P11_combined_report": lambda s, d: fl.combined_report(fl.combined_fields(_selected(s, d), "elasticsearchaux")),
    "P12_thresholds_by_kind": lambda s, d: _selected(s, d, threshold=0.5, aac_threshold=0.05).select("dataset", "path"),
    "S14_report_text": _report_text,
    "S15_selection_document": _document_round_trip,
    "X03_fields_per_dataset": lambda s, d: fl.fields_per_dataset(_selected(s, d), "elasticsearchaux").drop("pointer"),
    "X03_names_kept": _names_kept,
    "K1_dropped_keys": lambda s, d: fl.dropped_keys(
        _profile(s, d), ["_source", "metadata"], ["_index", "_id", "_score", "aacid", "metadata"]
    ),
}


def _profile_sql(where: str = "true") -> str:
    return f"""{raw_sql()},
totals AS (SELECT dataset, count(*) AS total_records FROM valid WHERE {where} GROUP BY 1),
unparsed AS (SELECT dataset, count(*) FILTER (NOT json_valid(value)) AS n_unparsed FROM raw WHERE {where} GROUP BY 1),
paths AS (SELECT dataset, replace(regexp_replace(t.fullkey, '^\\$\\.', ''), '"', '') AS path, count(*) AS n_records
  FROM valid, json_tree(valid.j) t WHERE {where} AND t.key IS NOT NULL
    AND NOT regexp_matches(t.fullkey, '\\[[1-9][0-9]*\\]') AND NOT regexp_matches(t.fullkey, '\\]$') GROUP BY 1, 2),
profile AS (SELECT * FROM paths JOIN totals USING (dataset) JOIN unparsed USING (dataset)),
named AS (SELECT *, replace(replace(replace(path, '.', '_'), '[', '_'), ']', '_') AS plain FROM profile)"""


def _selected_sql(condition: str = "n_records >= total_records * 0.2") -> str:
    return f"""{_profile_sql()},
selected AS (SELECT dataset, path, n_records, total_records, plain || CASE WHEN k > 1 THEN '__' || k ELSE '' END AS "column"
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset, lower(plain) ORDER BY path) AS k FROM named WHERE {condition}))"""


_AUX = "dataset IN ('metadata', 'journals', 'digital_lending')"
_AAC = "dataset LIKE 'aac\\_%' ESCAPE '\\'"


def _combined_sql(group: str) -> str:
    return f"""{_selected_sql()},
combined AS (SELECT path, datasets, plain || CASE WHEN k > 1 THEN '__' || k ELSE '' END AS "column" FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(plain) ORDER BY path) AS k FROM (
    SELECT path, list_sort(list(dataset)) AS datasets, replace(replace(replace(path, '.', '_'), '[', '_'), ']', '_') AS plain
    FROM selected WHERE {group} GROUP BY path)))"""


_SHARED = """SELECT path FROM selected WHERE {g} GROUP BY path
HAVING count(DISTINCT dataset) = (SELECT count(*) FROM totals WHERE {g}) AND count(DISTINCT dataset) > 1"""
_PCT = "round(n_records / total_records * 100, 2)"
_OWN = "SELECT dataset, path, \"column\" FROM selected"

SQL = {
    "P01_sample_rows": f"{raw_sql()}\nSELECT dataset, doc_id FROM raw WHERE {_KEY_HASH_SQL} % 1000000 < 200000",
    "P01_sample_files": f"""{raw_sql()}, files AS (SELECT DISTINCT dataset, file_name AS path FROM raw)
SELECT dataset, path FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY md5(path), path) AS k,
  count(*) OVER (PARTITION BY dataset) AS n FROM files) WHERE k <= greatest(1, floor(n * 0.2))""",
    "P02_key_paths_per_record": f"""{raw_sql()}
SELECT record_key, count(*) AS n_paths FROM valid, json_tree(valid.j) t WHERE t.key IS NOT NULL
  AND NOT regexp_matches(t.fullkey, '\\[[1-9][0-9]*\\]') AND NOT regexp_matches(t.fullkey, '\\]$') GROUP BY 1""",
    "P03_path_counts": f"{_profile_sql()}\nSELECT dataset, path, n_records, total_records, n_unparsed FROM profile",
    "P03_record_totals": f"{_profile_sql()}\nSELECT dataset, total_records AS n_records, n_unparsed FROM totals JOIN unparsed USING (dataset)",
    "P04_scaled_counts": f"""{_profile_sql(_KEY_HASH_SQL + ' % 1000000 < 200000')}
SELECT dataset, path, n_records AS sampled_n, n_records * 5 AS n_records, total_records * 5 AS total_records FROM profile""",
    "P05_selected_fields": f"{_selected_sql()}\nSELECT dataset, path, n_records, total_records FROM selected",
    "P06_column_names": f"""{_profile_sql()}
SELECT dataset, path, plain || CASE WHEN k > 1 THEN '__' || k ELSE '' END AS "column" FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, lower(plain) ORDER BY path) AS k FROM named)""",
    "P07_combined_aux": f'{_combined_sql(_AUX)}\nSELECT path, datasets, "column" FROM combined',
    "P07_combined_aac": f'{_combined_sql(_AAC)}\nSELECT path, datasets, "column" FROM combined',
    "P08_shared_aux": f"{_selected_sql()}\n{_SHARED.format(g=_AUX)}",
    "P08_shared_aac": f"{_selected_sql()}\n{_SHARED.format(g=_AAC)}",
    "P09_selected_report": f'{_selected_sql()}\nSELECT dataset, path, "column", {_PCT} AS presence_pct FROM selected',
    "P10_presence_report": f"{_profile_sql()}\nSELECT dataset, path, {_PCT} AS presence_pct, n_records, total_records FROM profile",
    "P11_combined_report": f"""{_combined_sql(_AUX)}
SELECT len(datasets)::INTEGER AS n_datasets, path, "column", datasets FROM combined""",
    "P12_thresholds_by_kind": _selected_sql(
        f"n_records >= total_records * CASE WHEN {_AAC} THEN 0.05 ELSE 0.5 END"
    )
    + "\nSELECT dataset, path FROM selected",
    "S14_report_text": f"""{_selected_sql()}
SELECT dataset, 'selected' AS section, row_number() OVER (PARTITION BY dataset ORDER BY path)::INTEGER AS position,
  format('{{:.2f}}', {_PCT}) AS presence_pct, n_records::VARCHAR AS n_records, total_records::VARCHAR AS total_records,
  path, "column" FROM selected
UNION ALL
SELECT dataset, 'all', row_number() OVER (PARTITION BY dataset ORDER BY n_records DESC, path)::INTEGER,
  format('{{:.2f}}', {_PCT}), n_records::VARCHAR, total_records::VARCHAR, path, '' FROM profile""",
    "S15_selection_document": f"""{_combined_sql(_AUX)}
{_OWN} UNION ALL SELECT 'combined', path, "column" FROM combined""",
    "X03_fields_per_dataset": f"""{_combined_sql(_AUX)}
SELECT dataset, path, "column" FROM selected WHERE NOT ({_AUX})
UNION ALL SELECT d, path, "column" FROM combined, (SELECT unnest(['metadata', 'journals', 'digital_lending']) AS d)""",
    "K1_dropped_keys": f"""{_profile_sql()}
SELECT dataset, path, n_records FROM profile WHERE (NOT contains(path, '.')
    AND path NOT IN ('_index', '_id', '_score', 'aacid', 'metadata'))
  OR (contains(path, '.') AND split_part(path, '.', 1) NOT IN ('_source', 'metadata'))""",
}
SQL["X03_names_kept"] = f"""{_profile_sql()},
odd AS (SELECT dataset, path, count(*) AS n FROM (SELECT dataset, replace(regexp_replace(t.fullkey, '^\\$\\.', ''), '"', '') AS path
  FROM valid, json_tree(valid.j) t WHERE doc_id % 2 = 1 AND t.key IS NOT NULL
    AND NOT regexp_matches(t.fullkey, '\\[[1-9][0-9]*\\]') AND NOT regexp_matches(t.fullkey, '\\]$')) GROUP BY 1, 2),
odd_totals AS (SELECT dataset, count(*) AS total FROM valid WHERE doc_id % 2 = 1 GROUP BY 1),
early AS (SELECT dataset, path FROM odd JOIN odd_totals USING (dataset) WHERE n >= total * 0.2),
every AS (SELECT dataset, path, plain, n_records >= total_records * 0.2 AS chosen, (dataset, path) IN (SELECT (dataset, path) FROM early) AS known
  FROM named),
dealt AS (SELECT *, row_number() OVER (PARTITION BY dataset, lower(plain) ORDER BY NOT known, path) AS k FROM every WHERE chosen OR known)
SELECT dataset, path, plain || CASE WHEN k > 1 THEN '__' || k ELSE '' END AS "column" FROM dealt WHERE chosen"""
SQL["P01_sample_files_by_size"] = f"""{raw_sql()},
files AS (SELECT dataset, file_name AS path, sum(strlen(value) + 1)::BIGINT AS length FROM raw GROUP BY 1, 2),
laid AS (SELECT *, least(1.0::DOUBLE, greatest(1, floor(count(*) OVER (PARTITION BY dataset) * 0.5)) * length::DOUBLE
  / sum(length::DOUBLE) OVER (PARTITION BY dataset)) AS chance FROM files),
ended AS (SELECT *, sum(chance) OVER (PARTITION BY dataset ORDER BY md5(path), path) - 0.37 AS last FROM laid)
SELECT dataset, path, length, round(1 / chance, 6) AS weight FROM ended WHERE floor(last) > floor(last - chance)"""
