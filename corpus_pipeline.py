"""A training corpus from ``documents``: filtered, deduplicated, without personal data, packed into sequences.

Every stage works on all that the one before it kept. ``run`` writes each stage's rows to the shared scratch folder and
reads them again, so a lost executor never sends the work back over a finished stage.

Defined cases, by stage:

* quality rules: a null or empty text has no words and is rejected, a text of any length is judged whole, repeated rows
  get equal verdicts
* n-gram join: of copies and near copies the smallest id stays, of rows that repeat id and text one; different texts
  under one id, null included, stay where one of them stands for its component
* suffix dedup: a null text stays null; passages are told on the texts as given, so every place of a repeat loses it
* pseudonyms: null and empty texts stay; equal values get equal pseudonyms in every document
* packing: a text without words is its closing id alone; texts over a sequence are cut into pieces; ties go by place

An empty table gives an empty result at every stage. Columns beyond ``COLUMNS`` are dropped by the first stage, whatever
their names; null languages and sources pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import ngram_join, packing, personal, quality, suffixes
from quire.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now (null for a null text)."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8), the one with the smallest id."""
    return ngram_join.one_of_each(docs, percent=80, width=5).select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the passages of 400 bytes or more, or of over 50 words, that occur elsewhere."""
    return _measured(suffixes.remove_repeats(docs, words=51))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms."""
    return _measured(personal.pseudonymise(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("pii", pii),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # the join, the passages, the pseudonyms and the packing are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
