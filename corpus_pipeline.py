"""Corpus preparation: each stage takes (spark, docs, sf_dir) and returns a DataFrame.

Every stage takes rows with NULLs in any column, empty and very long texts, repeated rows and
ids, further columns and empty tables; what it does with them stands in its docstring, and for
all of them a NULL text counts as an empty one and other columns are passed on as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm import decontamination as benchmark
from scrubline.llm import mixing as sources
from scrubline.llm import near_dedup as copies
from scrubline.llm import sharding as ring
from scrubline.llm import toxicity as insults
from scrubline.llm.storage import passing, row_key, scratch, ship, stored, without

#: SQL can't express the classifier, the seeded mix or the ring; tests use brute force.
ORACLE_SQL = None


def _unlisted(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text, by :func:`row_key`, aren't in ``gone``."""
    key = row_key(F.coalesce("text", F.lit("")))
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", key.alias("_key"))
    return without(keyed, gone, ["doc_id", "_key"]).select("_row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go; an empty or NULL text stays, a very long one is judged whole.

    Equal texts go or stay alike, whatever their ids.  Empty tables stay empty.
    """
    ship(spark)
    return insults.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id.

    Rows of a group that share its smallest doc_id, or that all have none, stay together.
    """
    ship(spark)
    with passing(spark):
        gone = copies.keyed_duplicates(docs).where(~F.col("kept")).select("doc_id", "_key")
        gone = stored(gone, lasting=True)
    return _unlisted(docs, gone)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; one without words stays, as it holds no window.

    Rows that repeat a doc_id or have none are judged singly, by their text.
    """
    ship(spark)
    with passing(spark):
        found = benchmark.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
        gone = stored(found.where("contaminated").select("doc_id", "_key"), lasting=True)
    return _unlisted(docs, gone)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, so some not at all and some repeatedly.

    Texts without words count nothing and come as often as their source is taken whole; a NULL
    source is a source.  Of repeated rows as many stay as the mix takes of them all.
    """
    ship(spark)
    return sources.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row; rows that repeat a doc_id or have none get slots of their own,
    and a very long text fills a shard like many short ones."""
    ship(spark)
    return ring.shards_of(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again."""
    folder = scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        with passing(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
