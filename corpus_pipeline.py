"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Toxic documents go, one document of each near-duplicate group stays, secrets are masked, sources are replicated towards
their target weights, and the texts that are left are encoded as pieces. Every stage works on all rows that
the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from probewell.llm import mixing, near_dup, pieces, secrets, toxicity
from probewell.llm._store import save

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from ``labels``.

    Null and empty texts stay, as do repeated rows and rows with a null doc_id, unless their text is rejected. An empty table
    gives an empty one; columns beyond those of documents are dropped, here and in the other stages.
    """
    scored = toxicity.score(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 0").select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id. Rows with a null doc_id stay.

    Null and empty texts have no group and stay. Of several rows with one doc_id one stays: the least by text, lang, source
    and n_chars, nulls first.
    """
    kept = near_dup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    null = docs.where("doc_id is null").select(*COLUMNS)
    least = F.min(F.struct("text", "lang", "source", "n_chars")).alias("row")
    return docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(least).select("doc_id", "row.*").unionByName(null)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every confirmed secret replaced by a mask; n_chars follows the text and is null for a null text."""
    out = secrets.redact(secrets.scan(docs.select(*COLUMNS)))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents that bring the sources to their target weights; a doc_id can stand several times or not at all."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every row, with the digest of what they decode to.

    The copies that mixing has made of a document are numbered again, as equal rows can be in any order, and each gets
    pieces of its own. Null and empty texts have no pieces; null doc_ids share one key.
    """
    copies = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    return pieces.encoded_rows(docs.select("doc_id", "text", F.row_number().over(copies).alias("copy_no")))


STAGES = [("toxicity", clean), ("near_dedup", distinct), ("secrets", masked), ("mixing", mixed), ("pieces", encoded)]
# The classifier, the forest and the pieces are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
