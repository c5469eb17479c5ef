"""Near-duplicates by chosen-path set similarity join over sets of word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.components import components
from scrubline.llm.storage import passing, row_key, sifted, stored, texts
from scrubline.llm.textscan import SPACES, mix, shingles, words

TREES = 6
BRANCHES = 2
COORDINATES = 64
SMALL_NODE = 64
#: Members that a large node's others are matched with before it branches, and rows in a task.
PIVOTS = 32
CHUNK = 4096
#: Pairs of signatures and shingles of full sets that one task compares.
PAIRS = 1 << 25
SHINGLES = 1 << 22
#: Beyond this depth, nodes that ask for more are compared in blocks.
DEPTH = 6
#: Estimated similarity below which a pair isn't confirmed: five standard errors below 0.75.
LEAST_ESTIMATE = 0.75 - 5 * (0.75 * 0.25 / COORDINATES) ** 0.5
_RNG = np.random.default_rng(977)
_A = _RNG.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 2**63, COORDINATES, dtype=np.uint64)
SKETCH = "doc_id long, _key long, n int, rid binary, signature binary"


def _sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Per run of texts: first row, distinct shingles of each text, all shingles, their numbers."""
    for row, _, hashes, counts in words(column, SPACES):
        value, per_text = shingles(hashes, counts)
        ends = np.cumsum(per_text)
        yield row, [np.unique(value[e - n : e]) for e, n in zip(ends, per_text)], value, per_text


def _set_id(members: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        total = np.array([members.sum(), mix(members).sum()], dtype=np.uint64)
    return total.tobytes()


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        for row, sets, value, per_text in _sets(batch.column(2)):
            full = np.flatnonzero(per_text)
            starts = (np.cumsum(per_text) - per_text)[full]
            signature = np.zeros((len(per_text), COORDINATES), dtype=np.uint32)
            for k in range(COORDINATES if len(full) else 0):
                least = np.minimum.reduceat(value * _A[k] + _B[k], starts)
                signature[full, k] = least >> np.uint64(32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(row, len(sets)),
                    keys.slice(row, len(sets)),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([_set_id(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in signature], pa.binary()),
                ],
                ["doc_id", "_key", "n", "rid", "signature"],
            )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, sets, _, _ in _sets(batch.column(0)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_set_id(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["rid", "members"],
            )


def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep pairs whose signatures agree often enough to be worth confirming."""
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            for k in (2, 3)
        )
        near = (a == b).mean(axis=1) >= LEAST_ESTIMATE
        yield batch.select(["a", "b"]).filter(pa.array(near))


def linked(similarity: int):
    """Keep pairs whose full sets reach the similarity, in hundredths."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return keep


def close(pairs: DataFrame, reps: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs (a, b) of sets whose sizes allow the similarity and whose signatures are near it."""
    one, two = (
        reps.select(F.col("sid").alias(k), F.col("n").alias(f"n{k}"), F.col("signature").alias(f"s{k}")) for k in ("a", "b")
    )
    sized = 100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb")
    met = pairs.distinct().join(one, "a").join(two, "b").where(sized).select("a", "b", "sa", "sb")
    return stored(met.mapInArrow(alike, "a long, b long"))


def confirm(pairs: DataFrame, groups: DataFrame | None, reps: DataFrame, docs: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) among candidate pairs and inside groups, judged on full sets of whole texts.

    ``groups`` hold ``key, chunk, sid, comp, odd``: odd members are compared with all others that
    are of another component.  A group gives as many links as join its components.
    """
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select("b"))
    ends = (ends if groups is None else ends.union(groups.select("sid"))).distinct()
    named = stored(ends.join(reps.select("sid", "rid", "low"), "sid"))
    # Rows may pass the filter without being wanted, and copies may pass beside their
    # representative; a set is kept once.
    rows = sifted(docs, named.select(F.col("low").alias("doc_id")), ["doc_id"]).where("_maybe").select("text")
    made = rows.mapInArrow(full_sets, "rid binary, members binary").join(named.select("sid", "rid"), "rid")
    members = stored(made.select("sid", "members").dropDuplicates(["sid"]))
    left = pairs.join(members.select(F.col("sid").alias("a"), F.col("members").alias("ma")), "a")
    both = left.join(members.select(F.col("sid").alias("b"), F.col("members").alias("mb")), "b")
    found = both.select("a", "b", "ma", "mb").mapInArrow(linked(similarity), "a long, b long")
    if groups is not None:
        held = groups.join(members, "sid").select("key", "chunk", "sid", "comp", "odd", "members")
        sets = held.repartition("key", "chunk").sortWithinPartitions("key", "chunk")
        found = found.union(sets.mapInArrow(_joined(similarity), "a long, b long"))
    return stored(found.distinct())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Runs of rows of one (key, chunk); True where a new group begins."""
    last = None
    for batch in batches:
        group = np.stack([batch.column("key").to_numpy(), batch.column("chunk").to_numpy()], axis=1)
        bounds = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1), len(group)]
        for low, high in zip(bounds[:-1], bounds[1:]):
            for at in range(low, high, 1000):
                yield tuple(group[at]) != last, batch.slice(at, min(1000, high - at))
                last = tuple(group[at])


def _signatures(piece: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(piece.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal coordinates of every row of ``a`` with every row of ``b``."""
    equal = np.zeros((len(a), len(b)), np.uint8)
    for k in range(COORDINATES):
        equal += a[:, k, None] == b[None, :, k]
    return equal / np.float32(COORDINATES)


CANDIDATES = "a long, b long, key long, chunk long, sid long, comp long, odd boolean"


class _Node:
    """Members of one (key, chunk) so far, and the candidates among them."""

    def __init__(self, key: int, chunk: int) -> None:
        self.key, self.chunk = key, chunk
        self.sid, self.comp, self.n = (np.zeros(0, np.int64) for _ in range(3))
        self.odd, self.near = np.zeros(0, bool), np.zeros(0, bool)
        self.signature = np.zeros((0, COORDINATES), np.uint32)
        self.pairs: list[np.ndarray] | None = []
        self.found = 0

    def add(self, piece: pa.RecordBatch, similarity: int) -> None:
        """Match new members with the odd ones, which come first."""
        first = len(self.sid)
        for name in ("sid", "comp", "n", "odd"):
            column = piece.column(name).to_numpy(zero_copy_only=False)
            setattr(self, name, np.concatenate([getattr(self, name), column]))
        self.near = np.concatenate([self.near, np.zeros(piece.num_rows, bool)])
        signature = _signatures(piece)
        self.signature = np.concatenate([self.signature, signature[self.odd[first:]]])
        odd = np.flatnonzero(self.odd)
        if not len(odd):
            return
        near = _agreement(signature, self.signature) >= LEAST_ESTIMATE
        new = np.arange(first, len(self.sid))
        near &= self.comp[new][:, None] != self.comp[odd][None, :]
        n, m = self.n[new][:, None], self.n[odd][None, :]
        near &= 100 * np.minimum(n, m) >= similarity * np.maximum(n, m)
        # Two odd members meet in every chunk; they are paired in the first one, once.
        near &= ~self.odd[new][:, None] | ((odd[None, :] < new[:, None]) & (self.chunk == 0))
        i, j = np.nonzero(near)
        self.near[new[i]] = self.near[odd[j]] = True
        self.found += len(i)
        if self.pairs is not None:
            self.pairs.append(np.stack([self.sid[new[i]], self.sid[odd[j]]]))
            if self.found > 2 * len(self.sid) + SMALL_NODE:
                self.pairs = None

    def candidates(self) -> pa.RecordBatch:
        """Pairs if they are few, else the members that are in any."""
        if self.pairs is not None:
            pairs = np.concatenate([np.zeros((2, 0), np.int64), *self.pairs], axis=1)
            size = pairs.shape[1]
            none = [pa.nulls(size, kind) for kind in (pa.int64(),) * 4 + (pa.bool_(),)]
            columns = [pa.array(pairs.min(axis=0)), pa.array(pairs.max(axis=0)), *none]
        else:
            at = np.flatnonzero(self.near)
            same = [pa.array(np.full(len(at), x, np.int64)) for x in (self.key, self.chunk)]
            columns = [*(pa.nulls(len(at), pa.int64()),) * 2, *same, *(pa.array(x[at]) for x in (self.sid, self.comp, self.odd))]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "key", "chunk", "sid", "comp", "odd"])


def _candidates(similarity: int):
    """Candidates of a node by signature: its odd members with all that are of another component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = None
        for new, piece in _pieces(batches):
            if new:
                if node:
                    yield node.candidates()
                node = _Node(piece.column("key")[0].as_py(), piece.column("chunk")[0].as_py())
            node.add(piece, similarity)
        if node:
            yield node.candidates()

    return compare


def _links_of(sets: list[np.ndarray], sid: list[int], comp: list[int], odd: list[bool], similarity: int) -> list[tuple[int, int]]:
    """Links that join the components of a group, found by counting shared shingles exactly."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    parent = {c: c for c in comp}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for i in np.flatnonzero(odd):
        low, high = np.searchsorted(tokens, sets[i], "left"), np.searchsorted(tokens, sets[i], "right")
        width = high - low
        at = np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero(100 * both >= similarity * (size + size[i] - both)):
            a, b = root(comp[i]), root(comp[j])
            if a != b:
                parent[a] = b
                out.append((min(sid[i], sid[j]), max(sid[i], sid[j])))
    return out


def _joined(similarity: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def links() -> pa.RecordBatch:
            sid, comp, odd, sets = (list(x) for x in zip(*held))
            found = _links_of([np.frombuffer(s, np.uint64) for s in sets], sid, comp, odd, similarity)
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for new, piece in _pieces(batches):
            if new and held:
                yield links()
                held = []
            held += zip(*(piece.column(c).to_pylist() for c in ("sid", "comp", "odd", "members")))
        if held:
            yield links()

    return link


def _pivot_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every member of a chunk with the most similar of the chunk's first members."""
    pivots, signatures = np.zeros(0, np.int64), np.zeros((0, COORDINATES), np.uint32)
    for new, piece in _pieces(batches):
        if new:
            pivots, signatures = pivots[:0], signatures[:0]
        sid, signature = piece.column("sid").to_numpy(), _signatures(piece)
        more = max(0, PIVOTS - len(pivots))
        first = len(pivots)
        pivots = np.concatenate([pivots, sid[:more]])
        signatures = np.concatenate([signatures, signature[:more]])
        agreement = _agreement(signature, signatures)
        # A pivot is matched with those before it.
        for i in range(min(more, len(sid))):
            agreement[i, first + i :] = -1
        best = agreement.argmax(axis=1)
        score = agreement[np.arange(len(sid)), best]
        near = score >= LEAST_ESTIMATE
        columns = [pa.array(sid[near]), pa.array(pivots[best[near]]), pa.array(score[near].astype(np.float64)), piece.column("key").filter(pa.array(near))]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "score", "key"])


def _grouped(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.repartition("key", "chunk").sortWithinPartitions("key", "chunk", *order)


def _compare(rows: DataFrame, similarity: int) -> DataFrame:
    """Candidates of nodes ``(key, sid, comp, n, odd, signature, chunks, blocks)``.

    The members of a node are dealt to its chunks, its odd members to all of them.  Where these
    are too many for a task they are dealt to blocks, each of which meets all members.
    """
    zero = F.lit(0).cast("long")
    many = F.col("blocks") > 1

    def to(chunk: Column, block: Column, odd: Column) -> list[Column]:
        key = F.when(many, F.xxhash64("key", block)).otherwise(F.col("key")).alias("key")
        return [key, chunk.alias("chunk"), "sid", "comp", "n", odd.alias("odd"), "signature"]

    odd = rows.where("odd").withColumn("_chunk", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    odd = odd.select(*to(F.col("_chunk"), F.pmod(F.xxhash64("sid", F.lit(7)), F.col("blocks")), F.lit(True)))
    rest = rows.where(~F.col("odd") | many).withColumn("_block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    rest = rest.select(*to(F.pmod(F.xxhash64("sid"), F.col("chunks")), F.col("_block"), F.lit(False)))
    return _grouped(odd.union(rest), F.col("odd").desc()).mapInArrow(_candidates(similarity), CANDIDATES)


def _pivots(rows: DataFrame) -> DataFrame:
    """Two candidate pairs for nearly every member of large nodes in which many are similar.

    Every node has pivots of its own, so that a member, being in many nodes, meets many.
    """
    chunks = F.ceil(F.col("size") / CHUNK)
    chunked = rows.select("key", F.pmod(F.xxhash64("sid"), chunks).alias("chunk"), "sid", "signature")
    found = _grouped(chunked, F.xxhash64("key", "sid")).mapInArrow(_pivot_pairs, "a long, b long, score double, key long")
    best = found.groupBy("a", F.pmod("key", F.lit(2)).alias("_half")).agg(F.max_by("b", "score").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, similarity: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row; see :func:`keyed_duplicates`."""
    return keyed_duplicates(docs, similarity).drop("_key")


def keyed_duplicates(docs: DataFrame, similarity: int = 75) -> DataFrame:
    """``doc_id, _key, n_shingles, component_id, kept`` for every row.

    Sets are the distinct five-word shingles of whole texts (fewer words: one shingle; NULL,
    empty or blank text: no set, linked with nothing).  Texts with equal sets count as one
    until the end, so copies cost one row each.  In every tree a set picks two of its minwise
    tokens and goes down to their nodes.  A small node first links its members to one leader,
    a large one to the most similar of a few pivots.  Where that leaves a node with several
    components, the members outside its largest one are compared with all others if a task
    can do that; else the node branches on, at last in blocks.  Few candidates are confirmed as
    pairs of full sets; where a node holds many, its members' full sets are compared in the node.
    At a similarity of 0.75 a pair misses all 12 first nodes with probability 6e-8.

    doc_id and _key name a row; rows that repeat both are copies and share alike.
    A NULL doc_id gets the smallest id of its component, or NULL if there is none.  Empty
    tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = texts(docs)
    with passing(spark):
        sketches = stored(docs.select("doc_id", row_key("text").alias("_key"), "text").mapInArrow(sketch, SKETCH), lasting=True)
        reps = sketches.where("n > 0").groupBy("rid", "n", "signature").agg(F.min("doc_id").alias("low"))
        reps = stored(reps.withColumn("sid", F.monotonically_increasing_id()))
        found = _linked_sets(docs, reps, similarity)
        home = reps.select("rid", "sid", "low").join(found.withColumnRenamed("id", "sid"), "sid", "left")
        home = home.select("rid", "low", F.coalesce("component", "sid").alias("_c"))
        lowest = home.groupBy("_c").agg(F.min("low").alias("_low"))
        named = stored(home.join(lowest, "_c").select("rid", F.col("_low").alias("_named")), lasting=True)
    component = F.when(F.col("n") > 0, F.col("_named")).otherwise(F.col("doc_id"))
    return sketches.drop("signature").join(named, "rid", "left").select(
        "doc_id",
        "_key",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _value(coordinate: Column) -> Column:
    """One value of the signature: a minwise token."""
    return F.substring(F.col("signature"), coordinate * 4 + 1, F.lit(4))


def _linked_sets(docs: DataFrame, reps: DataFrame, similarity: int) -> DataFrame:
    """Components of similar sets by ``sid``; sets without a link are left out."""

    def branches(rows: DataFrame, depth: int) -> DataFrame:
        at = F.explode(F.sequence(F.lit(0), F.lit(BRANCHES - 1)))
        if depth == 0:
            coordinate = F.col("tree") * BRANCHES + F.col("_at")
        else:
            coordinate = F.pmod(F.xxhash64("key", F.lit(depth), F.col("_at")), F.lit(COORDINATES)).cast("int")
        return rows.withColumn("_at", at).withColumn("_on", coordinate).select(
            F.xxhash64("key", "tree", "_on", _value(F.col("_on"))).alias("key"), "tree", "sid", "n"
        )

    def nodes(rows: DataFrame) -> DataFrame:
        sizes = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min("sid").alias("leader")
        )
        return stored(rows.join(sizes.where("size > 1"), "key"))

    known_sets = reps.select("sid", "signature")
    roots = reps.select("sid", "n", "signature", F.lit(0).cast("bigint").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    level = nodes(branches(roots, 0))
    stars = level.where((F.col("size") <= SMALL_NODE) & (F.col("sid") != F.col("leader")))
    pairs = stars.select(F.col("leader").alias("a"), F.col("sid").alias("b"))
    pairs = pairs.union(_pivots(level.where(F.col("size") > SMALL_NODE).join(known_sets, "sid")))
    links = confirm(close(pairs, reps, similarity), None, reps, docs, similarity)
    kin = stored(components(links).withColumnRenamed("id", "sid"))
    candidates = []
    for depth in range(1, DEPTH + 1):
        comps = level.join(kin, "sid", "left").withColumn("comp", F.coalesce("component", "sid")).drop("component", "leader")
        shares = comps.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("_n"), F.sum("n").alias("_s"))
        shares = shares.groupBy("key").agg(
            F.max_by("comp", "_n").alias("_major"), F.max("_n").alias("_most"), F.max_by("_s", "_n").alias("_held"), F.sum("_n").alias("_all"), F.sum("_s").alias("_sum")
        )
        odd, held = F.col("_all") - F.col("_most"), F.col("_sum") - F.col("_held")
        parts = lambda a, b: F.ceil(F.greatest(a, b, F.lit(1.0)))
        mixed = shares.where("_most < _all").select(
            "key",
            "_major",
            parts(F.col("_all") / CHUNK, F.col("_sum") / SHINGLES).alias("chunks"),
            parts(odd * F.col("_all") / PAIRS, held / SHINGLES).alias("blocks"),
        )
        open_ = comps.join(mixed, "key").withColumn("odd", F.col("comp") != F.col("_major"))
        open_ = stored(open_.drop("_major", "size", "shingles").join(known_sets, "sid"))
        last = depth == DEPTH
        candidates.append(stored(_compare(open_ if last else open_.where("blocks = 1"), similarity)))
        large = open_.where("blocks > 1")
        if last or large.isEmpty():
            break
        level = nodes(branches(large, depth))
    found = reduce(DataFrame.union, candidates)
    pairs, groups = found.where("a is not null").select("a", "b").distinct(), found.where("a is null")
    more = confirm(stored(pairs), groups.drop("a", "b"), reps, docs, similarity)
    return components(links.union(more))
