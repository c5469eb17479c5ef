"""Benchmark decontamination over a distributed positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.storage import row_key, stored, texts
from scrubline.llm.textscan import SIGNS, words

WINDOW = 13
#: Window terms looked for in one pass over the texts.  Their hashes go to every task, 8 bytes
#: each, so 4 MiB at most; a larger benchmark is taken in blocks, each a pass of its own.
TERMS_PER_PASS = 1 << 19
ITEM = "item string, words array<long>"
INDEX = "doc_id long, _key long, n_words long, terms array<long>, places array<int>"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, after, hashes, counts in words(batch.column(1), SIGNS):
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, after - row), lists], ["item", "words"])


def windows(benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """``item, window, size, at, term``: the terms of every run of ``length`` words of an item
    (of the whole item where it is shorter), with their offsets."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = items.where("item is not null").mapInArrow(_hashed, ITEM).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(length))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - size + 1))
    runs = hashed.withColumn("_start", starts).select("item", size.alias("size"), F.slice("words", F.col("_start"), size).alias("run"))
    runs = runs.distinct().withColumn("window", F.xxhash64("item", "size", "run"))
    return runs.select("item", "window", "size", F.posexplode("run").alias("at", "term"))


def _counted(terms: bytes):
    """Occurrences of the terms in whole texts, one row per term and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(terms, np.int64)
        total = np.zeros(len(known), np.int64)
        for batch in batches if len(known) else ():
            for _, _, hashes, _ in words(batch.column(0), SIGNS):
                place, found = _find(known, hashes.view(np.int64))
                total += np.bincount(place[found], minlength=len(known))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known[used]), pa.array(total[used])], ["term", "n"])

    return count


def _find(known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return place, known[place] == values


def _indexed(terms: bytes, anchors: bytes, reach: int):
    """Per text its words and the postings of test terms within reach of an anchor."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rare = np.frombuffer(terms, np.int64), np.frombuffer(anchors, np.int64)
        for batch in batches:
            for row, after, hashes, counts in words(batch.column(2), SIGNS):
                values = hashes.view(np.int64)
                ends = np.concatenate([[0], np.cumsum(counts)])
                if len(known):
                    is_term = _find(known, values)[1]
                    at = np.flatnonzero(is_term)
                    near = at[_find(rare, values[at])[1]] if len(rare) else at[:0]
                else:
                    at = near = np.zeros(0, np.int64)
                # Words between the first and last place an anchor's window can touch, in its text.
                text = np.searchsorted(ends, near, side="right") - 1
                change = np.zeros(len(values) + 1, np.int64)
                np.add.at(change, np.maximum(near - reach, ends[text]), 1)
                np.add.at(change, np.minimum(near + reach + 1, ends[text + 1]), -1)
                at = at[np.cumsum(change)[at] > 0]
                text = np.searchsorted(ends, at, side="right") - 1
                bounds = pa.array(np.searchsorted(at, ends), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, after - row),
                        batch.column(1).slice(row, after - row),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(bounds, pa.array(values[at])),
                        pa.ListArray.from_arrays(bounds, pa.array((at - ends[text]).astype(np.int32))),
                    ],
                    ["doc_id", "_key", "n_words", "terms", "places"],
                )

    return index


def _blocks(test: DataFrame) -> list[DataFrame]:
    """The windows, in blocks whose terms are few enough to be sent to every task."""
    blocks = max(1, -(-test.count() // TERMS_PER_PASS))
    return [test.where(F.pmod("window", F.lit(blocks)) == k) for k in range(blocks)]


def _hashes(terms: DataFrame) -> np.ndarray:
    """Sorted distinct term hashes of one block, so at most ``TERMS_PER_PASS``."""
    return np.sort(np.array([r[0] for r in terms.select("term").distinct().collect()], dtype=np.int64))


def positional_index(docs: DataFrame, test: DataFrame, reach: int = WINDOW - 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For one block of windows: the word count of every row, the stored postings
    ``(doc_id, _key, place, term)``, and the corpus frequency of every term.

    A posting is stored where it can matter: the word occurs in the block and lies within
    ``reach`` of the rarest term of some window.  Whole texts are scanned: once for the
    frequencies, once for the postings.
    """
    docs = texts(docs).select("doc_id", row_key().alias("_key"), "text")
    known = _hashes(test)
    counted = docs.select("text").mapInArrow(_counted(known.tobytes()), "term long, n long")
    frequency = stored(counted.groupBy("term").agg(F.sum("n").alias("n")))
    rare = _hashes(_ordered(test, frequency).where("turn = 1"))
    index = stored(docs.mapInArrow(_indexed(known.tobytes(), rare.tobytes(), reach), INDEX))
    postings = index.select("doc_id", "_key", F.explode(F.arrays_zip("terms", "places")).alias("_p")).select(
        "doc_id", "_key", F.col("_p.places").alias("place"), F.col("_p.terms").alias("term")
    ).distinct()
    return index.select("doc_id", "_key", "n_words"), postings, frequency


def _ordered(test: DataFrame, frequency: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, their terms numbered from the rarest on."""
    known = test.join(frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    one = Window.partitionBy("window")
    turn = F.row_number().over(one.orderBy("n", "term", "at"))
    return known.withColumn("_least", F.min("n").over(one)).where("_least > 0").withColumn("turn", turn).drop("_least")


def phrases(postings: DataFrame, test: DataFrame, frequency: DataFrame) -> DataFrame:
    """``doc_id, _key, item, start, size``: every exact occurrence of every window.

    The rarest term's list gives the possible starts.  They are cut by the second rarest
    term's list at its offset, then by those of all others.
    """
    ordered = stored(_ordered(test, frequency))
    first = ordered.where("turn = 1").select("item", "window", "size", F.col("at").alias("_at"), "term")
    starts = postings.join(first, "term").select(
        "doc_id", "_key", "item", "window", "size", (F.col("place") - F.col("_at")).alias("start")
    ).where("start >= 0")

    def cut(starts: DataFrame, terms: DataFrame) -> DataFrame:
        needed = starts.join(terms.select("window", "at", "term"), "window").withColumn("place", F.col("start") + F.col("at"))
        same = (
            F.col("p.doc_id").eqNullSafe(F.col("s.doc_id"))
            & (F.col("p._key") == F.col("s._key"))
            & (F.col("p.place") == F.col("s.place"))
            & (F.col("p.term") == F.col("s.term"))
        )
        return needed.alias("s").join(postings.alias("p"), same, "left_semi")

    columns = ["doc_id", "_key", "item", "window", "size", "start"]
    second = cut(starts, ordered.where("turn = 2")).select(*columns)
    starts = stored(second.union(starts.where("size = 1").select(*columns)))
    rest = cut(starts, ordered.where("turn > 2")).groupBy(*columns).count().where(F.col("count") == F.col("size") - 2)
    return rest.select(*columns).union(starts.where("size <= 2")).select("doc_id", "_key", "item", "start", "size")


def proximity(docs: DataFrame, benchmark: DataFrame, slack: int, length: int = WINDOW) -> DataFrame:
    """``doc_id, item, start, size``: windows found loosely.

    Looser than a phrase: ``start`` is where the window's rarest term would put it, and every
    other term occurs at most ``slack`` words from its place.
    """
    keys = ["doc_id", "_key", "item", "window", "size", "start"]
    found = []
    for test in _blocks(stored(windows(benchmark, length))):
        _, postings, frequency = positional_index(docs, test, length - 1 + slack)
        ordered = stored(_ordered(test, frequency))
        first = ordered.where("turn = 1").select("item", "window", "size", F.col("at").alias("_at"), "term")
        starts = postings.join(first, "term").select(*keys[:-1], (F.col("place") - F.col("_at")).alias("start"))
        needed = starts.join(ordered.select("window", "at", F.col("term").alias("_t")), "window")
        lists = postings.select(F.col("doc_id").alias("_d"), F.col("_key").alias("_k"), "place", "term")
        same = (
            F.col("doc_id").eqNullSafe(F.col("_d"))
            & (F.col("_key") == F.col("_k"))
            & (F.col("term") == F.col("_t"))
            & (F.abs(F.col("place") - F.col("start") - F.col("at")) <= slack)
        )
        near = needed.join(lists, same).groupBy(*keys).agg(F.count_distinct("at").alias("_met"))
        found.append(near.where(F.col("_met") == F.col("size")).select("doc_id", "item", "start", "size"))
    return reduce(DataFrame.union, found).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, share: int = 20) -> DataFrame:
    """``doc_id, _key, n_words, n_hit, n_items, items_sha256, contaminated`` for every row.

    Words are runs of letters and digits after lower-casing A-Z.  A word inside any occurrence
    of a window is hit; a text is contaminated if at least one word in ``share`` is.  NULL and
    wordless texts have no words and no hits; items without words or id are left out; rows
    with equal doc_id and text get equal results; empty tables give no rows or no hits.
    """
    found, counted = [], None
    for test in _blocks(stored(windows(benchmark, length))):
        n_words, postings, frequency = positional_index(docs, test, length - 1)
        counted = n_words if counted is None else counted
        found.append(phrases(postings, test, frequency))
    found = stored(reduce(DataFrame.union, found))
    keys = ["doc_id", "_key"]
    spans = found.select(*keys, "start", (F.col("start") + F.col("size")).alias("end"))
    spans = spans.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    before = F.max("end").over(Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    hit = spans.withColumn("_fresh", fresh).groupBy(*keys).agg(F.sum("_fresh").alias("n_hit"))
    items = found.groupBy(*keys).agg(F.array_sort(F.collect_set("item")).alias("_items"))
    both = hit.join(items, [hit.doc_id.eqNullSafe(items.doc_id), hit._key == items._key]).select(
        hit.doc_id.alias("_d"), hit._key.alias("_k"), "n_hit", "_items"
    )
    n_hit = F.coalesce("n_hit", F.lit(0))
    listed = F.coalesce("_items", F.array().cast("array<string>"))
    return counted.join(both, [counted.doc_id.eqNullSafe(both._d), counted._key == both._k], "left").select(
        "doc_id",
        "_key",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
