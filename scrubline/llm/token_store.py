"""Token ids as raw payloads, with keyed access through a minimal perfect hash index."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrubline.llm.storage import passing, stored, texts
from scrubline.llm.textscan import mix
from scrubline.llm.tokenizing import units

CHUNK_BYTES = 1 << 20
KEYS_PER_BUCKET = 2048
#: Keys that one call of `fetch` takes.
MOST_KEYS = 1000
PAYLOAD = (
    "shard int, chunk int, doc_ids array<long>, copies array<int>, sizes array<long>, "
    "n_tokens long, width int, payload binary"
)
INDEX = (
    "bucket long, n int, levels array<binary>, fingerprints binary, shards binary, chunks binary, "
    "firsts binary, sizes binary"
)
PLACE = "doc_id long, copy int, shard int, chunk int, first long, n_tokens long"


def _encoded(path: str, end_id: int):
    """Ids of whole texts as raw bytes, where the texts lie."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = units(path)
        end = table.packed([end_id])
        for batch in batches:
            ids = [own + end for own in table.ids_of(batch.column(2))]
            width = pa.array(np.full(len(ids), table.width, np.int32))
            columns = [batch.column(0), batch.column(1), width, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_hash", "width", "ids"])

    return encode


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of documents in order to chunks, which hold whole documents."""
    shard, chunk = TaskContext.get().partitionId(), 0
    ids, copies, sizes, parts, held, width = [], [], [], [], 0, 0
    last, copy = object(), 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([chunk], pa.int32()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([copies], pa.list_(pa.int32())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([sum(sizes)], pa.int64()),
                pa.array([width], pa.int32()),
                pa.array([b"".join(parts)], pa.binary()),
            ],
            ["shard", "chunk", "doc_ids", "copies", "sizes", "n_tokens", "width", "payload"],
        )

    for batch in batches:
        for doc_id, width, payload in zip(*(batch.column(k).to_pylist() for k in range(3))):
            copy = copy + 1 if doc_id == last else 0
            last = doc_id
            ids.append(doc_id)
            copies.append(copy)
            sizes.append(len(payload) // width)
            parts.append(payload)
            held += len(payload)
            if held >= CHUNK_BYTES:
                yield out()
                chunk += 1
                ids, copies, sizes, parts, held = [], [], [], [], 0
    if ids:
        yield out()


def write_payload(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Encode all texts and write raw ids in ascending doc_id order (NULL last) to ``folder``.

    Texts are encoded where they lie, once; their ids, a third of their size, are then put in
    order.  A shard is one range of ids and one folder; its chunks hold the little-endian ids of whole
    documents, two bytes each if the vocabulary allows it.  Rows with one doc_id are its
    copies 0, 1, ... in a shard, ordered by their text's hash.
    """
    spark = docs.sparkSession
    with passing(spark):
        rows = texts(docs).select("doc_id", F.xxhash64("text").alias("_hash"), "text")
        encoded = stored(rows.mapInArrow(_encoded(tokenizer, end_id), "doc_id long, _hash long, width int, ids binary"))
        order = [F.col("doc_id").asc_nulls_last()]
        placed = encoded.repartitionByRange(*order).sortWithinPartitions(*order, "_hash")
        chunks = placed.select("doc_id", "width", "ids").mapInArrow(_chunks, PAYLOAD)
        chunks.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return open_payload(spark, folder)


def open_payload(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PAYLOAD).parquet(folder).select(*(c.split()[0] for c in PAYLOAD.split(", ")))


def _key_hash(doc_ids: pd.Series, copies: pd.Series, seed: int) -> np.ndarray:
    empty = doc_ids.isna().to_numpy()
    ids = doc_ids.fillna(0).astype("int64").to_numpy().view(np.uint64)
    with np.errstate(over="ignore"):
        rest = copies.to_numpy().astype(np.uint64) * np.uint64(2) + empty + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        return mix(ids + mix(rest))


def _levels(doc_ids: pd.Series, copies: pd.Series) -> tuple[list[bytes], np.ndarray]:
    """Minimal perfect hash of distinct keys: the bit arrays and every key's slot.

    On each level a key that is alone on its bit is settled there; the others go on to the
    next level with another seed.  A key's slot is the number of set bits before its own.
    """
    slots, open_ = np.zeros(len(doc_ids), np.int64), np.arange(len(doc_ids))
    levels, settled = [], 0
    while len(open_):
        width = max(64, -(-len(open_) // 4) * 8)
        bit = (_key_hash(doc_ids.iloc[open_], copies.iloc[open_], len(levels) + 1) % np.uint64(width)).astype(np.int64)
        alone = np.bincount(bit, minlength=width) == 1
        mine = alone[bit]
        slots[open_[mine]] = settled + (np.cumsum(alone) - 1)[bit[mine]]
        settled += int(alone.sum())
        levels.append(np.packbits(alone).tobytes())
        open_ = open_[~mine]
    return levels, slots


def _slots(levels: list[bytes], doc_ids: pd.Series, copies: pd.Series) -> np.ndarray:
    """Slots of keys, -1 where no level has the key's bit."""
    slots, open_, settled = np.full(len(doc_ids), -1), np.arange(len(doc_ids)), 0
    for level, packed in enumerate(levels):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))
        hashed = _key_hash(doc_ids.iloc[open_], copies.iloc[open_], level + 1)
        bit = (hashed % np.uint64(len(bits))).astype(np.int64)
        mine = bits[bit] == 1
        slots[open_[mine]] = settled + (np.cumsum(bits) - 1)[bit[mine]]
        settled += int(bits.sum())
        open_ = open_[~mine]
    return slots


def _build(group: pd.DataFrame) -> pd.DataFrame:
    levels, slots = _levels(group["doc_id"], group["copy"])
    order = np.argsort(slots)
    prints = (_key_hash(group["doc_id"], group["copy"], 0) >> np.uint64(32)).astype("<u4")
    packed = {
        "fingerprints": prints,
        "shards": group["shard"].to_numpy("<i4"),
        "chunks": group["chunk"].to_numpy("<i4"),
        "firsts": group["first"].to_numpy("<i8"),
        "sizes": group["n_tokens"].to_numpy("<i8"),
    }
    return pd.DataFrame(
        {"bucket": group["bucket"].iloc[:1], "n": [len(group)], "levels": [levels]}
        | {k: [v[order].tobytes()] for k, v in packed.items()}
    )


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets)).alias("bucket")


def directory(payload: DataFrame) -> DataFrame:
    """Place of every document: shard, chunk, first id inside the chunk, number of ids."""
    return payload.select("shard", "chunk", "doc_ids", "copies", "sizes").mapInArrow(_listed, PLACE)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, chunk, ids, copies, sizes in zip(*(batch.column(k).to_pylist() for k in range(5))):
            n = np.array(sizes, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(copies, pa.int32()),
                    pa.array([shard] * len(n), pa.int32()),
                    pa.array([chunk] * len(n), pa.int32()),
                    pa.array(np.cumsum(n) - n),
                    pa.array(n),
                ],
                ["doc_id", "copy", "shard", "chunk", "first", "n_tokens"],
            )


def write_index(payload: DataFrame, folder: str) -> DataFrame:
    """One minimal perfect hash per bucket of about ``KEYS_PER_BUCKET`` keys, written to ``folder``."""
    places = directory(payload)
    keys = payload.select(F.sum(F.size("sizes"))).first()[0] or 0
    buckets = max(1, keys // KEYS_PER_BUCKET)
    built = places.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(_build, INDEX)
    built.withColumn("buckets", F.lit(buckets)).write.parquet(folder)
    return payload.sparkSession.read.parquet(folder)


def _look_up(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    names = ["doc_id", "copy", "shard", "chunk", "first", "n_tokens"]
    if not len(keys) or not len(index):
        return pd.DataFrame({c: [] for c in names})
    row = index.iloc[0]
    slots = _slots(list(row["levels"]), keys["doc_id"], keys["copy"])
    prints = np.frombuffer(row["fingerprints"], "<u4")
    own = (_key_hash(keys["doc_id"], keys["copy"], 0) >> np.uint64(32)).astype("<u4")
    found = (slots >= 0) & (prints[np.maximum(slots, 0)] == own)
    slots = slots[found]
    out = keys.loc[found, ["doc_id", "copy"]].reset_index(drop=True)
    for name, column, kind in (("shard", "shards", "<i4"), ("chunk", "chunks", "<i4"), ("first", "firsts", "<i8"), ("n_tokens", "sizes", "<i8")):
        out[name] = np.frombuffer(row[column], kind)[slots]
    return out


def look_up(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Places of ``keys(doc_id, copy)``: one hash per level and one compared fingerprint each.

    Unknown keys are left out; a stored fingerprint of 32 bits lets one in 4e9 of them pass.
    """
    first = index.select("buckets").first()
    buckets = first[0] if first else 1
    keyed = keys.select("doc_id", "copy", _bucket(buckets))
    return keyed.groupBy("bucket").cogroup(index.drop("buckets").groupBy("bucket")).applyInPandas(_look_up, PLACE)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, chunk, sizes, width, payload in zip(*batch.columns):
            n = np.array(sizes.as_py(), np.int64)
            ids = np.frombuffer(payload.as_buffer(), f"<u{width.as_py()}").astype("<u4")
            first = np.cumsum(n) - n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard.as_py()] * len(n), pa.int32()),
                    pa.array([chunk.as_py()] * len(n), pa.int32()),
                    pa.array(first),
                    pa.array([zlib.crc32(ids[a : a + k]) for a, k in zip(first, n)], pa.int64()),
                ],
                ["shard", "chunk", "first", "ids_crc32"],
            )


def read_back(payload: DataFrame, places: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of documents at ``places``, read from the payload.

    Chunks are read where they lie; only small rows are shuffled.
    """
    chunks = payload.select("shard", "chunk", "n_tokens")
    by_shard = chunks.groupBy("shard").agg(F.sum("n_tokens").alias("_all"))
    before = by_shard.select(
        F.col("shard"), (F.sum("_all").over(Window.orderBy("shard")) - F.col("_all")).alias("_before")
    )
    inside = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n_tokens")
    base = chunks.withColumn("_inside", inside).join(before, "shard").select(
        "shard", "chunk", (F.col("_before") + F.col("_inside")).alias("_base")
    )
    read = payload.select("shard", "chunk", "sizes", "width", "payload").mapInArrow(
        _read, "shard int, chunk int, first long, ids_crc32 long"
    )
    return places.join(read, ["shard", "chunk", "first"]).join(base, ["shard", "chunk"]).select(
        "doc_id", (F.col("_base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_store(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write payload and index below ``folder``; the two tables read back.

    NULL text is empty and gives the end id alone.  NULL doc_ids come last.  Rows with one
    doc_id are copies of a key, ordered by their text's hash.  Very long texts are one document
    in one chunk.  An empty table gives empty files.  Other columns are ignored.
    """
    payload = write_payload(docs, tokenizer, end_id, f"{folder}/ids")
    return payload, write_index(payload, f"{folder}/index")


def open_store(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return open_payload(spark, f"{folder}/ids"), spark.read.parquet(f"{folder}/index")


def keys_of(payload: DataFrame) -> DataFrame:
    """``doc_id, copy`` of every document in the store."""
    return directory(payload).select("doc_id", "copy")


def _picked(wanted: dict[tuple[int, int], list[tuple]]):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, chunk, width, payload in zip(*batch.columns):
                ids = np.frombuffer(payload.as_buffer(), f"<u{width.as_py()}")
                places = wanted.get((shard.as_py(), chunk.as_py()), [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in places], pa.int64()),
                        pa.array([p[1] for p in places], pa.int32()),
                        pa.array([ids[f : f + n].tolist() for _, _, f, n in places], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "copy", "ids"],
                )

    return pick


def fetch(payload: DataFrame, index: DataFrame, keys: list[tuple[int | None, int]]) -> DataFrame:
    """``doc_id, copy, ids`` of a few documents, at most ``MOST_KEYS``, from their chunks alone.

    Each key costs a look into its bucket of the index; of the payload only the folders of the
    shards and the chunks that hold a key are read.  Unknown keys are left out.
    """
    if len(keys) > MOST_KEYS:
        raise ValueError(f"at most {MOST_KEYS} keys; use look_up and read_back for more")
    spark = payload.sparkSession
    asked = spark.createDataFrame(list(dict.fromkeys(keys)), "doc_id long, copy int")
    first = index.select("buckets").first()
    buckets = [r[0] for r in asked.select(_bucket(first[0] if first else 1)).distinct().collect()]
    places = look_up(index.where(F.col("bucket").isin(buckets)), asked).collect()
    wanted: dict[tuple[int, int], list[tuple]] = {}
    for p in places:
        wanted.setdefault((p["shard"], p["chunk"]), []).append((p["doc_id"], p["copy"], p["first"], p["n_tokens"]))
    shards = sorted({s for s, _ in wanted})
    here = reduce(lambda a, b: a | b, ((F.col("shard") == s) & (F.col("chunk") == c) for s, c in wanted), F.lit(False))
    found = payload.where(F.col("shard").isin(shards)).where(here)
    return found.select("shard", "chunk", "width", "payload").mapInArrow(_picked(wanted), "doc_id long, copy int, ids array<long>")
