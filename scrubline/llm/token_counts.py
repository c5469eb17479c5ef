"""Token counts of whole texts through a cache of content digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.storage import row_key, scratch, stored, texts
from scrubline.llm.tokenizing import units, version

CACHE = "digest binary, tokenizer string, n_tokens long"


def _counted(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = units(path)
        for batch in batches:
            n = [len(table.ids(text.as_py())) // table.width for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return count


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    Content is normalised by taking NULL as empty (anything more would change counts) and
    known by its SHA-256; with the digest of the tokenizer file that is the key of ``cache``,
    a Parquet folder the cluster shares.  Each distinct content that isn't there is encoded
    once and appended; the counts then come from the cache.  Without a folder a new, empty
    cache is used.  Copies of a text are told apart by doc_id while texts move, so no task
    gets all of them.  Repeated rows and NULL ids get counts like any other row; empty tables
    give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    cache = cache or scratch(spark)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    rows = texts(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    small = stored(rows.select("doc_id", "digest", row_key("digest").alias("_key"), F.octet_length("text").cast("long").alias("n_bytes")))

    def known() -> DataFrame:
        found = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version(tokenizer))
        # Two jobs may have appended the same content at the same time.
        return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    misses = small.groupBy("digest").agg(F.min("_key").alias("_key")).join(known(), "digest", "left_anti")
    wanted = rows.withColumn("_key", row_key("digest")).join(misses.hint("shuffle_hash"), ["digest", "_key"], "left_semi")
    encoded = wanted.select("digest", "text").mapInArrow(_counted(tokenizer), "digest binary, n_tokens long")
    encoded.dropDuplicates(["digest"]).select("digest", F.lit(version(tokenizer)).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    return small.join(known(), "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
