"""Ranked lexical search of many items at once, sharing the partial scores they have in common."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.storage import stored, texts
from scrubline.llm.textscan import SIGNS, words

BEST = 10
#: Terms of the items of one pass, about.  A pass sends 8 bytes a term and 16 a shared set to every
#: task and gathers one row a term; more items are taken in blocks, each a pass of its own.
TERMS_PER_PASS = 1 << 16
#: Neighbours in order of frequency that are looked at as a shared pair.
REACH = 16
#: Partial scores held at once: sets times documents.
CELLS = 1 << 22
POSTINGS = "doc_id long, n long, terms array<int>, times array<int>"


@dataclass
class SharedPlan:
    """Sets of terms that items share, each summed up once per document.

    ``terms`` are sorted hashes.  Terms that occur equally often in the same items are one
    class, ``class_of`` a term.  Set k < len(operands) is class ``operands[k][0]`` taken
    ``operands[k][1]`` times; each round adds sets that are the sum of two earlier ones.
    An item is the sum of the sets in ``parts``.
    """

    terms: np.ndarray
    class_of: np.ndarray
    operands: np.ndarray
    rounds: list[tuple[np.ndarray, np.ndarray]]
    parts: list[tuple[int, np.ndarray]]

    @property
    def sets(self) -> int:
        return len(self.operands) + sum(len(a) for a, _ in self.rounds)

    def additions(self) -> int:
        """Additions per document: of each shared set once and of each item's sets."""
        return sum(len(a) for a, _ in self.rounds) + sum(max(0, len(p) - 1) for _, p in self.parts)

    def partial_scores(self, of_class: np.ndarray) -> np.ndarray:
        """Scores of every set, a row each, from those of the classes."""
        scores = np.empty((self.sets, of_class.shape[1]), np.int64)
        at = len(self.operands)
        np.multiply(of_class[self.operands[:, 0]], self.operands[:, 1:], out=scores[:at])
        for a, b in self.rounds:
            np.add(scores[a], scores[b], out=scores[at : at + len(a)])
            at += len(a)
        return scores


def shared_plan(items: list[tuple[int, dict[int, int]]]) -> SharedPlan:
    """Mine the term sets that items (number, times of each term) share.

    Classes of terms with the same items come first.  Then, in rounds, pairs of sets that occur
    together in several items become sets of their own, the most frequent first; every set
    joins one new pair a round.  Each pair saves an addition per item but one.
    """
    uses = defaultdict(list)
    for k, (_, times) in enumerate(items):
        for term, n in times.items():
            uses[term].append((k, n))
    terms = np.array(sorted(uses), np.int64)
    classes: dict[tuple, int] = {}
    class_of = np.array([classes.setdefault(tuple(uses[t]), len(classes)) for t in terms.tolist()], np.int64)
    operands: dict[tuple[int, int], int] = {}
    holds: list[set[int]] = [set() for _ in items]
    for signature, c in classes.items():
        for k, n in signature:
            holds[k].add(operands.setdefault((c, n), len(operands)))
    rounds, sets = [], len(operands)
    while True:
        frequency = Counter(s for held in holds for s in held)
        together = Counter()
        for held in holds:
            order = sorted(held, key=lambda s: (-frequency[s], s))
            for i, a in enumerate(order):
                together.update((min(a, b), max(a, b)) for b in order[i + 1 : i + 1 + REACH])
        chosen, taken = [], set()
        for (a, b), n in sorted(together.items(), key=lambda x: (-x[1], x[0])):
            if n > 1 and a not in taken and b not in taken:
                taken |= {a, b}
                chosen.append((a, b))
        if not chosen:
            break
        pair_of = {a: (b, sets + i) for i, (a, b) in enumerate(chosen)}
        for held in holds:
            for a in [a for a in held if a in pair_of]:
                b, joined = pair_of[a]
                if b in held:
                    held -= {a, b}
                    held.add(joined)
        rounds.append(tuple(np.array(chosen, np.int64).T))
        sets += len(chosen)
    parts = [(number, np.array(sorted(held), np.int64)) for (number, _), held in zip(items, holds)]
    return SharedPlan(terms, class_of, np.array(list(operands), np.int64).reshape(-1, 2), rounds, parts)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, after, hashes, counts in words(batch.column(1), SIGNS):
            item = np.repeat(np.arange(row, after), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(item)), pa.array(hashes.view(np.int64))], ["number", "term"]
            )


def _postings(terms: bytes):
    """Per text its number of terms and the places of known terms with their occurrences."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(terms, np.int64)
        for batch in batches:
            for row, after, hashes, counts in words(batch.column(1), SIGNS):
                values = hashes.view(np.int64)
                place = np.minimum(np.searchsorted(known, values), len(known) - 1)
                found = known[place] == values
                text = np.repeat(np.arange(len(counts)), counts)[found]
                used, times = np.unique(text * len(known) + place[found], return_counts=True)
                bounds = pa.array(np.searchsorted(used, np.arange(len(counts) + 1) * len(known)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, after - row),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(bounds, pa.array((used % len(known)).astype(np.int32))),
                        pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                    ],
                    ["doc_id", "n", "terms", "times"],
                )

    return index


def _document_counts(size: int):
    """Documents of each term, one row a term and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["place", "df"])

    return count


def length_weight(n: np.ndarray, texts: int, length: int) -> np.ndarray:
    """``25 + 75 * n * texts div length``, whole at any size."""
    if 75 * int(n.max(initial=0)) * texts < 1 << 63:
        return 25 + 75 * n * texts // length
    return np.array([25 + 75 * k * texts // length for k in n.tolist()], np.int64)


class _Leaders:
    """The best documents of one item so far: score, then smallest doc_id, NULL last."""

    def __init__(self, best: int) -> None:
        self.best = best
        self.score, self.missing, self.doc = (np.zeros(0, t) for t in (np.int64, bool, np.int64))

    def offer(self, score: np.ndarray, missing: np.ndarray, doc: np.ndarray) -> None:
        least = self.score[-1] if len(self.score) == self.best else 1
        at = np.flatnonzero(score >= max(1, least))
        if not len(at):
            return
        parts = [np.concatenate(p) for p in zip((self.score, self.missing, self.doc), (score[at], missing[at], doc[at]))]
        order = np.lexsort((parts[2], parts[1], -parts[0]))[: self.best]
        self.score, self.missing, self.doc = (p[order] for p in parts)


def _leaders(plan: SharedPlan, weights: np.ndarray, texts: int, length: int, best: int):
    """The best documents of every item among a task's rows."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_Leaders(best) for _ in plan.parts]
        classes = int(plan.class_of.max()) + 1
        step = max(1, CELLS // (plan.sets + classes))
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                rows = batch.slice(low, step)
                size = rows.num_rows
                missing = np.array(rows.column(0).is_null())
                doc = rows.column(0).fill_null(0).to_numpy()
                lists = rows.column(2)
                term, times = lists.flatten().to_numpy(), rows.column(3).flatten().to_numpy().astype(np.int64)
                at = np.repeat(np.arange(size), lists.value_lengths().to_numpy())
                spread = 8 * length_weight(rows.column(1).to_numpy(), texts, length)
                score = weights[term] * (1_000_000_000 * times // (1000 * times + spread[at]))
                of_class = np.zeros(classes * size, np.int64)
                np.add.at(of_class, plan.class_of[term] * size + at, score)
                sets = plan.partial_scores(of_class.reshape(classes, size))
                for leaders, (_, parts) in zip(found, plan.parts):
                    leaders.offer(sets[parts].sum(axis=0), missing, doc)
        number = np.repeat([n for n, _ in plan.parts], [len(f.score) for f in found])
        doc, missing, score = (np.concatenate([getattr(f, c) for f in found]) for c in ("doc", "missing", "score"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), pa.array(doc, mask=missing), pa.array(score)], ["number", "doc_id", "score"]
        )

    return rank


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the documents with the highest scores for each item.

    Terms are runs of letters, digits and characters beyond ASCII of whole texts, A-Z in lower
    case, told apart by 64-bit hashes.  One pass over the documents keeps, per document, its
    length and the occurrences of terms that any item holds.  A second one, over these postings,
    sums up every set of terms that items share once per document and each item from its sets
    (:func:`shared_plan`); a task hands on the best documents of each item it has met.

    NULL and empty texts have no term: such a document is never found and such an item finds
    nothing.  Equal rows of ``items`` are one item; a NULL or repeated item_id with another text
    is an item of its own.  Rows with a repeated doc_id are ranked singly, those without one
    after others of the same score.  Empty tables give no rows; other columns are ignored.
    """
    asked = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    asked = stored(asked.withColumn("number", F.monotonically_increasing_id()))
    held = asked.select("number", "text").mapInArrow(_hashed, "number long, term long").groupBy("number", "term").agg(F.count(F.lit(1)).alias("times"))
    held = stored(held)
    blocks = max(1, -(-held.count() // TERMS_PER_PASS))
    rows, totals, found = texts(docs).select("doc_id", "text"), None, []
    for k in range(blocks):
        block: dict[int, dict[int, int]] = defaultdict(dict)
        for number, term, times in held.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == k).collect():
            block[number][term] = times
        if not block:
            continue
        plan = shared_plan(sorted(block.items()))
        size = len(plan.terms)
        postings = stored(rows.mapInArrow(_postings(plan.terms.tobytes()), POSTINGS).where("n > 0"))
        totals = totals or postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not totals[0]:
            break
        counted = postings.select("terms").mapInArrow(_document_counts(size), "place long, df long")
        weights = np.full(size, 0, np.int64)
        for place, df in counted.groupBy("place").agg(F.sum("df")).collect():
            weights[place] = math.floor(1000 * math.log((2 * totals[0] + 2) / (2 * df + 1)))
        met = postings.where(F.size("terms") > 0).mapInArrow(
            _leaders(plan, weights, *totals, best), "number long, doc_id long, score long"
        )
        found.append(met)
    if not found:
        return asked.where(F.lit(False)).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(asked.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")
