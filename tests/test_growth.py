"""What the checks write grows in number, not in size."""

import pytest
from pyspark.sql import functions as F

from checks import storage_checks as st


def _documents(spark, path, rows, digests):
    text = F.expr(f"array_join(transform(sequence(1, {digests}), i -> sha2(concat(id, '.', i), 256)), '')")
    spark.range(0, rows, 1, 4).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"),
                                      F.concat(F.lit("src"), F.col("id") % 20).alias("source")).withColumn(
        "n_chars", F.length("text").cast("bigint")).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_parts_follow_the_texts(spark, tmp_path):
    sf = _documents(spark, tmp_path, 100, 16)  # 1024 bytes each
    assert st.parts_for(spark, sf, 4) == 4
    assert st.parts_for(spark, sf, 4, 10_240) == 10


def test_compaction_of_a_larger_table_makes_fewer_files(spark, tmp_path):
    sf = _documents(spark, tmp_path, 4000, 400)  # 100 MB: twelve files a dataset are more than the target each
    for name in ("S18_compaction_by_base", "S18_compaction_by_directory"):
        assert {r["fewer_files"] for r in st.QUERIES[name](spark, sf).collect()} == {True}


@pytest.mark.parametrize("name", ["S02_zstd_lines", "S02_seekable_lines", "S19_merge_patterns", "S10_parquet_directory"])
def test_writers_deal_to_as_many_tasks_as_there_are_texts(spark, tmp_path, monkeypatch, name):
    sf, dealt, real = _documents(spark, tmp_path, 60, 2), [], st.readers.spread
    monkeypatch.setattr(st, "parts_for", lambda *a: 17)
    monkeypatch.setattr(st.readers, "spread", lambda df, n: (dealt.append(n), real(df, n))[1])
    st.QUERIES[name](spark, sf).collect()
    assert 17 in dealt
