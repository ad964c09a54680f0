"""A training corpus from ``documents``: language ID, quality classifier,
n-gram Jaccard join (one document of each group stays), packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. The first three return
the rows they keep, with the columns of ``documents``; the last returns one row
per piece of a packed sequence.

Defined results: a table without rows gives none; extra columns of ``docs`` are
dropped; a document of null or letterless text is rejected as of no language.
Of a group of near duplicates the row with the least doc_id stays (a null id
comes last), of several such rows the one with the least hash of the text, and
of rows that repeat as a whole any one.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import documents
from stridelake.llm.op1_jaccard_join import jaccard_join
from stridelake.llm.op3_quality import classify as classify_quality
from stridelake.llm.op3_quality import fit, labels_table
from stridelake.llm.op5_packing import pack
from stridelake.llm.op8_language import UND, train
from stridelake.llm.op8_language import classify as classify_language
from stridelake.session import bounded, configure, cut, per_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language."""
    configure(spark)
    return classify_language(docs, train(docs), COLUMNS).where(
        F.col("lang_pred") != UND).select(*COLUMNS)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier predicts as label 1."""
    configure(spark)
    return classify_quality(docs, fit(docs, labels_table(spark, sf_dir)), COLUMNS).where(
        F.col("predicted") == 1).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, and all other rows."""
    configure(spark)
    docs = docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash"))
    me = ["doc_id", "text_hash"]
    linked = cut(jaccard_join(docs, keep=me).where("n_links > 0"), "pipeline-linked")
    stays = per_key(linked.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")), "pipeline-stays")
    others = cut(linked.join(stays, "root").where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) &
          (F.col("text_hash") == F.col("first.text_hash"))))
        .select(*(F.col(c).alias(f"_{c}") for c in me)).distinct(), "pipeline-copies")
    again = cut(linked.groupBy(*me).count().where("count > 1")
                .select(*(F.col(c).alias(f"_{c}") for c in me)), "pipeline-repeats")

    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in me))
    left = docs.join(bounded(others, others.count()), same, "left_anti")
    if not again.isEmpty():  # rows that repeat as a whole: one of them
        again = bounded(again, again.count())
        left = left.join(again, same, "left_anti").unionByName(
            left.join(again, same, "left_semi").dropDuplicates(me))
    return left.select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    configure(spark)
    return pack(docs)


STAGES = [("language", language), ("quality", good), ("near_duplicates", distinct),
          ("packing", packed)]

#: The stages learn from the data; no SQL says what they do.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return cut(STAGES[-1][1](spark, docs, sf_dir), "pipeline-packed")
