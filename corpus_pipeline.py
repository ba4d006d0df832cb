"""The corpus pipeline: toxicity, line dedup, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs`` as they came, whatever extra ones there are.

* toxicity drops the documents that score 0.5 or more; the lexicon is learned from
  ``labels`` and the texts at hand. Documents without a match stay.
* line_dedup takes cross-site boilerplate lines out of texts; no row goes. A document
  of hardly anything else is left whole only if the next stage links it to another one.
* near_duplicates keeps the smallest id of every group of near-duplicates, linked from a
  similarity of 0.80 on; documents without words and rows without an id are kept.
* packing gives the pieces of all texts with their places in sequences.

Null or empty texts, repeated rows and empty tables follow the operators' rules: rows
that share an id are one document, they stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewire.llm import lines, minhash, packing, toxicity
from tablewire.llm.queries import WORD_BPE
from tablewire.llm.shared import fold_of, read_table, settle

#: Similarity in percent from which on texts are near-duplicates.
NEAR_PERCENT = 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    train = read_table(spark, sf_dir, "labels").where(fold_of("doc_id") != 0)
    lexicon = toxicity.learn(docs, train)
    return docs.where(toxicity.rating(spark, lexicon, F.col("text"))["score"] < 0.5)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(docs, min_sites=8, max_share=0.9, min_words=4, copies=near_copies)


def near_copies(candidates: DataFrame) -> DataFrame:
    """``candidate`` of those that are near-duplicates of a candidate with another id."""
    found = minhash.near_duplicates(candidates, words=5, percent=NEAR_PERCENT, key="candidate")
    named = found.select(F.col("key").alias("candidate"), "component_id").join(candidates.select("candidate", "key"), "candidate")
    named = settle(named.distinct(), "named")
    several = settle(named.groupBy("component_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a < b"), "several")
    return named.join(several, "component_id", "left_semi").select("candidate")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(docs, words=5, percent=NEAR_PERCENT)
    gone = settle(found.where(~F.col("kept") & F.col("key").isNotNull()).select(F.col("key").alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, WORD_BPE, end_id=0, capacity=2048).withColumnRenamed("key", "doc_id")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: Learned scores, sketches of similarity and the packing have no SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
