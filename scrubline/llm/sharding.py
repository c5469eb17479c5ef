"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.storage import placed

VIRTUAL_NODES = 256


def ring(shards: int, virtual: int = VIRTUAL_NODES) -> tuple[list[int], list[int]]:
    """Sorted places of all virtual nodes, and the shard each belongs to.

    A shard's nodes depend on its number alone, so another shard only adds nodes.
    """
    nodes = sorted(
        (int.from_bytes(blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards)
        for v in range(virtual)
    )
    return [n for n, _ in nodes], [s for _, s in nodes]


def segments(loads: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """Split the ring-ordered rows into ``(first place, rows, shard, first slot)``.

    ``loads[k]`` rows belong to node ``k``.  Shard capacities differ by one at most and add up
    to all rows.  A node's first rows stay while its shard has room; the others walk on
    clockwise, in order, to the next nodes whose shards have room.  Ends with every row placed.
    """
    rows = sum(loads)
    room = [rows // shards + (s < rows % shards) for s in range(shards)]
    first, cut = 0, []
    over: list[tuple[int, int]] = []
    for load, owner in zip(loads, owners):
        stay = min(load, room[owner])
        room[owner] -= stay
        if stay:
            cut.append((first, stay, owner))
        over.append((first + stay, load - stay))
        first += load
    walking: deque[list[int]] = deque()
    nodes = len(owners)
    for step in range(2 * nodes):
        node = step % nodes
        owner = owners[node]
        while walking and room[owner]:
            at, count = walking[0]
            taken = min(count, room[owner])
            room[owner] -= taken
            cut.append((at, taken, owner))
            if taken == count:
                walking.popleft()
            else:
                walking[0] = [at + taken, count - taken]
        if step < nodes and over[node][1]:
            walking.append(list(over[node]))
        if step >= nodes and not walking:
            break
    slots = [0] * shards
    out = []
    for at, count, owner in sorted(cut):
        out.append((at, count, owner, slots[owner]))
        slots[owner] += count
    return out


def shards_of(docs: DataFrame, shards: int = 16, virtual: int = VIRTUAL_NODES) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    The law is ``rows``: counts differ by one at most.  A document's place on the ring is a
    hash of its text, so that equal texts come to one shard as far as its capacity lets them;
    its virtual node is the next one clockwise.  Rows are ordered by place and doc_id and
    numbered range by range; the loads of the virtual nodes, a fixed number, decide on the
    driver where the ring order is cut.  A text held by a third of all rows is split by
    doc_id.  ``size`` is the text's UTF-8 bytes plus one (NULL: one); NULL ids come first;
    rows equal in all columns share a place and get slots of their own; an empty table gives
    no rows; other columns are ignored.
    """
    places, owners = ring(shards, virtual)
    # Beyond the last node the ring starts anew, at the first node's shard.
    places, owners = [*places, 2**63 - 1], [*owners, owners[0]]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("_bytes"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_place"),
    )
    ordered = placed(rows, F.col("_place").asc(), F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc())

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(len(places), np.int64)
        for batch in batches:
            node = np.searchsorted(np.array(places), batch.column(0).to_numpy())
            load += np.bincount(node, minlength=len(places))
        used = np.flatnonzero(load)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(load[used])], ["node", "n"])

    counted = ordered.select("_place").mapInArrow(nodes, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    loads = [0] * len(places)
    for node, n in counted.collect():
        loads[node] = n
    cuts = segments(loads, owners, shards)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, _, owner, slot = (np.array(c, np.int64) for c in zip(*cuts))
        for batch in batches:
            pos = batch.column("pos").to_numpy()
            at = np.searchsorted(first, pos, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(3)]
                + [pa.array(owner[at].astype(np.int32)), pa.array(slot[at] + pos - first[at])],
                ["doc_id", "_bytes", "text_crc32", "shard", "slot"],
            )

    put = ordered.select("doc_id", "_bytes", "text_crc32", "pos").mapInArrow(
        assign, "doc_id long, _bytes long, text_crc32 long, shard int, slot long"
    )
    return put.select(
        "doc_id",
        (F.col("_bytes") + 1).alias("size"),
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
