"""Vector codes over learnt codebooks; nearest entries are found by Orchard's search."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.storage import stored
from scrubline.operators.skew import join_groups

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
SUMS = "part int, entry int, place int, total long, used long"


def largest(part: int) -> int:
    """Size up to which components keep all sums of squares over ``PARTS`` parts within 64 bits."""
    return math.isqrt(((1 << 63) - 1) // (PARTS * max(part, 1))) // 2


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector and all its components are there and finite."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & ~odd)


def whole_numbers(column: pa.Array, part: int) -> np.ndarray:
    """``floor(256 * x)`` of every component, a row each, zeros after the last, cut into parts."""
    sizes = pc.list_value_length(column).to_numpy()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    top = largest(part)
    values = np.clip(np.floor(np.clip(values, -1e300, 1e300) * SCALE), -top, top).astype(np.int64)
    out = np.zeros((len(column), PARTS * part), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out.reshape(len(column), PARTS, part)


class Orchard:
    """Entries of one codebook, each with all entries in order of their distance to it."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.near = np.argsort(apart, axis=1, kind="stable")
        # An entry further than twice the present distance can't be nearer; squared, 4 times.
        self.reach = -(-np.take_along_axis(apart, self.near, axis=1) // 4)
        self.order = np.argsort(entries[:, 0], kind="stable")

    def _start(self, points: np.ndarray) -> np.ndarray:
        """An entry whose first component is next to the point's."""
        at = np.searchsorted(self.entries[self.order, 0], points[:, 0])
        return self.order[np.minimum(at, len(self.order) - 1)]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower of equally near ones, and its squared distance.

        All points search side by side.  A point goes down the list of its present entry, passes
        by entries that it has visited, jumps to the list of a better one, and ends where the list
        goes beyond twice its present distance.
        """
        entries, near, reach = self.entries, self.near, self.reach
        size = len(entries)
        best = self._start(points)
        distance = ((points - entries[best]) ** 2).sum(axis=1)
        visited = np.zeros((len(points), size), bool)
        visited[np.arange(len(points)), best] = True
        left, at = np.arange(len(points)), np.zeros(len(points), np.int64)
        while len(left):
            now = best[left]
            going = reach[now, at] <= distance[left]
            left, at, now = left[going], at[going], now[going]
            entry = near[now, at]
            new = ~visited[left, entry]
            row, entry = left[new], entry[new]
            visited[row, entry] = True
            found = ((points[row] - entries[entry]) ** 2).sum(axis=1)
            better = (found < distance[row]) | ((found == distance[row]) & (entry < best[row]))
            best[row[better]], distance[row[better]] = entry[better], found[better]
            jumped = np.zeros(len(left), bool)
            jumped[np.flatnonzero(new)[better]] = True
            at = np.where(jumped, 0, at + 1)
            rest = at < size
            left, at = left[rest], at[rest]
        return best, distance


def _assigned(books: list[Orchard], column: pa.Array, part: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows: the first one, their parts, nearest entries and squared distances."""
    step = max(1, (1 << 20) // max(1, PARTS * part))
    for low in range(0, len(column), step):
        parts = whole_numbers(column.slice(low, step), part)
        found = [books[p].nearest(parts[:, p]) for p in range(PARTS)]
        yield low, parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _sums(codebooks: np.ndarray):
    """Component sums and numbers of the parts nearest to each entry, once per task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, part = [Orchard(b) for b in codebooks], codebooks.shape[2]
        total, used = np.zeros(codebooks.shape, np.int64), np.zeros(codebooks.shape[:2], np.int64)
        for batch in batches:
            for _, parts, entry, _ in _assigned(books, batch.column(0), part):
                for p in range(PARTS):
                    np.add.at(total[p], entry[:, p], parts[:, p])
                    used[p] += np.bincount(entry[:, p], minlength=used.shape[1])
        p, e = np.nonzero(used)
        place = np.tile(np.arange(part), len(p))
        p, e = np.repeat(p, part), np.repeat(e, part)
        columns = (p.astype(np.int32), e.astype(np.int32), place.astype(np.int32), total[p, e, place], used[p, e])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "place", "total", "used"])

    return add


def _codes(codebooks: np.ndarray):
    """Code and error of every row, beside its other columns."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, part = [Orchard(b) for b in codebooks], codebooks.shape[2]
        for batch in batches:
            for low, parts, entry, distance in _assigned(books, batch.column(2), part):
                codes = pa.array([bytes(row).hex() for row in entry.astype(np.uint8)], pa.string())
                columns = [*batch.slice(low, len(parts)).columns[:2], codes, pa.array(distance.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return code


def learn(vectors: DataFrame, part: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks ``[part, entry, place]`` from the first rows by vec_id, improved over all rows.

    ``vectors`` holds ``vec_id`` and ``embedding`` of usable rows.  A round brings one row of
    sums per entry and place to the driver, as many as the codebooks have numbers.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow()
    codebooks = whole_numbers(first.column(0).combine_chunks(), part).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = vectors.select("embedding").mapInArrow(_sums(codebooks), SUMS)
        for row in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("used").alias("used")).collect():
            codebooks[row["part"], row["entry"], row["place"]] = row["total"] // row["used"]
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every usable row.

    A row is left out if its vector is NULL or holds a NULL or non-finite component.  Components
    become ``floor(256 * x)``, at most :func:`largest` in size, so that sums of squares fit 64
    bits.  Vectors are cut into 16 equal parts; one that is shorter than the longest, or whose
    length 16 doesn't divide, ends in zeros.  Codebooks start as the 64 rows with the smallest
    vec_id (fewer if there are fewer; NULL last, equal vec_ids by vector) and are improved in two
    rounds.  Equally near entries give way to the lower index.  ``label_error`` is the error
    summed over the rows of a label, NULLs together, or NULL where that is beyond 64 bits.
    Repeated rows and vec_ids are coded singly.  A table without usable rows gives no rows;
    other columns are ignored.
    """
    rows = stored(usable(vectors.select("vec_id", "label", "embedding")))
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 1
    codebooks = learn(rows, -(-longest // PARTS))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    shape = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    coded = stored(rows.mapInArrow(_codes(codebooks), shape))
    sums = stored(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")))
    return join_groups(coded.select("vec_id", "code", "error", "label"), sums, ["label"], "_n").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
