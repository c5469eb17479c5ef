"""Exact dedup by recipes of content-defined chunks, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.storage import sifted, stored, texts

SPACES = r"[\x20\x09-\x0D]+"
#: A word with the space after it; longer runs without a space are cut.
PIECE = r"[^ ]{0,63} |[^ ]{1,64}"
#: A chunk ends after a word whose hash ends in six zero bits, or after so many words.
ENDS, MOST = 64, 256
#: Groups with more than one in so many rows are split over several tasks, so at most as many.
HOT = 1000


def normalised(text: str | Column) -> Column:
    """Runs of white space as one space each."""
    return F.regexp_replace(text, SPACES, " ")


def chunked(rows: DataFrame, bits: int = 64) -> DataFrame:
    """``rows`` of normalised ``_text`` with ``ids`` and ``chunks``, which joined give the text.

    Where a chunk ends depends on the words in it alone, so equal passages are cut alike
    wherever they stand.  An id is the hash of its chunk, cut to ``bits``.
    """
    columns = [c for c in rows.columns if c != "_text"]
    pieces = rows.select(*columns, F.regexp_extract_all("_text", F.lit(PIECE), F.lit(0)).alias("_pieces"))
    last = lambda p, i: F.when(F.xxhash64(p).bitwiseAND(F.lit(ENDS - 1)) == 0, i + 1)
    found = pieces.select("*", F.array_compact(F.transform("_pieces", last)).alias("_found"), F.size("_pieces").alias("_size"))
    closed = (F.size("_found") > 0) & (F.try_element_at("_found", F.lit(-1)) == F.col("_size"))
    ended = found.withColumn("_ends", F.when(closed, F.col("_found")).otherwise(F.concat("_found", F.array("_size"))))
    begun = ended.withColumn("_starts", F.concat(F.array(F.lit(0)), F.slice("_ends", F.lit(1), F.size("_ends") - 1)))
    cut = lambda low, high: F.transform(
        F.sequence(low, high - 1, F.lit(MOST)), lambda at: F.struct(at.alias("at"), (F.least(at + MOST, high) - at).alias("n"))
    )
    bounds = F.when(F.col("_size") > 0, F.flatten(F.zip_with("_starts", "_ends", cut)))
    cuts = begun.select(*columns, "_pieces", F.coalesce(bounds, F.array().cast("array<struct<at:int,n:int>>")).alias("_cuts"))
    chunks = F.transform("_cuts", lambda c: F.array_join(F.slice("_pieces", c["at"] + 1, c["n"]), ""))
    whole = cuts.select(*columns, chunks.alias("chunks"))
    cut_off = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - bits) if bits < 64 else F.xxhash64(c)
    return whole.select(*columns, F.transform("chunks", cut_off).alias("ids"), "chunks")


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``doc_id, _row, text_sha256, ids, fixes, chunks`` for every row, written.

    ``ids`` and ``fixes`` together are the recipe: the ids of the text's chunks in order, and for
    chunks whose id belongs to another chunk too, their places and numbers among those.  So
    texts are equal exactly if their recipes are.  Ids are verified by bringing every distinct
    chunk together with its id once.
    """
    rows = texts(docs).select("doc_id", F.monotonically_increasing_id().alias("_row"), normalised("text").alias("_text"))
    parts = stored(chunked(rows.withColumn("text_sha256", F.sha2("_text", 256)), bits))
    known = parts.select(F.inline(F.arrays_zip("ids", "chunks"))).toDF("id", "chunk").distinct()
    shared = stored(known.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id"))
    if shared.isEmpty():
        return parts.withColumn("fixes", F.lit(""))
    numbered = known.join(shared, "id", "left_semi").withColumn(
        "_number", F.row_number().over(Window.partitionBy("id").orderBy("chunk"))
    )
    uses = parts.select("_row", F.posexplode(F.arrays_zip("ids", "chunks")).alias("_place", "_use"))
    uses = sifted(uses.select("_row", "_place", F.col("_use.ids").alias("id"), F.col("_use.chunks").alias("chunk")), shared, ["id"])
    fix = F.format_string("%d:%d", F.col("_place"), F.col("_number"))
    met = uses.where("_maybe").join(numbered, ["id", "chunk"]).groupBy("_row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", fix.alias("fix")))), lambda x: x["fix"]), ",").alias("fixes")
    )
    return stored(parts.join(met, "_row", "left").withColumn("fixes", F.coalesce("fixes", F.lit(""))))


def chunk_store(rows: DataFrame) -> DataFrame:
    """``id, chunk, uses`` of the recipes: every distinct chunk once, with how often it is used."""
    used = rows.select(F.inline(F.arrays_zip("ids", "chunks"))).toDF("id", "chunk")
    return used.groupBy("id", "chunk").agg(F.count(F.lit(1)).alias("uses"))


def exact_duplicates(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal if they are identical once runs of white space are one space each; NULL
    counts as empty.  The row with the smallest doc_id stays (a row without doc_id only if none
    of its group has one); of rows that repeat this doc_id one stays, so that each group keeps
    exactly one row.  An empty text has the empty recipe, so empty texts are one group, while a
    blank text is another.  Long texts are cut into chunks where they lie.  Empty tables give
    no rows; other columns are ignored.

    Rows of groups with one row never move.  The rows of a large group are counted where they
    lie, and meet their group in as many tasks as the group's size asks for.
    """
    rows = recipes(docs, bits).withColumn("_hash", F.xxhash64("ids", "fixes"))
    recipe = ["_hash", "ids", "fixes"]
    first = F.coalesce(F.min_by("_row", "doc_id"), F.min("_row")).alias("_first")
    groups = rows.groupBy(*recipe).agg(F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id"), first)
    several = stored(groups.where("group_size > 1"))
    share = -(-rows.count() // HOT) or 1
    split = several.withColumn("_parts", F.ceil(F.col("group_size") / share))
    hot = split.where("_parts > 1").groupBy("_hash").agg(F.max("_parts").alias("_parts"))
    marked = sifted(rows.select("doc_id", "_row", "text_sha256", *recipe), several, ["_hash"])
    alone = [F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")]
    single = marked.where("not _maybe").select("doc_id", *alone, "text_sha256")
    doubtful = marked.where("_maybe").join(F.broadcast(hot), "_hash", "left").withColumn(
        "_part", F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1)))
    )
    dealt = split.join(F.broadcast(hot.withColumnRenamed("_parts", "_all")), "_hash", "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_all", F.lit(1)) - 1))
    )
    met = doubtful.drop("_parts").join(dealt.drop("_parts", "_all"), [*recipe, "_part"], "left")
    found = F.col("_first").isNotNull()
    return single.unionByName(
        met.select(
            "doc_id",
            F.when(found, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            F.coalesce(F.col("_row") == F.col("_first"), F.lit(True)).alias("kept"),
            "text_sha256",
        )
    )
