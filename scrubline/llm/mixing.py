"""Mixing sources to target weights by fitting budgets as subset sums of document lengths."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.storage import placed, row_key, stored

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Words of a budget that the dynamic program fits at least, and the sums it tells apart at most.
EXACT_WORDS = 1 << 16
CELLS = 1 << 24
PLAN = "source string, size long, source_size long, target double, passes long, extra long"
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], share: float = 1.0, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> list[Fraction]:
    """Target per source, in order: weights repeat over the sources and share the budget; a
    target stops at ``most`` times its source's size and the excess is reshared by weight."""
    budget = Fraction(sum(sizes)) * Fraction(share)
    weight = [Fraction(weights[k % len(weights)]) for k in range(len(sizes))]
    out = [Fraction(0)] * len(sizes)
    open_ = [k for k, s in enumerate(sizes) if s]
    while open_:
        unit = budget / sum(weight[k] for k in open_)
        full = [k for k in open_ if unit * weight[k] > most * sizes[k]]
        if not full:
            for k in open_:
                out[k] = unit * weight[k]
            break
        for k in full:
            out[k] = Fraction(most * sizes[k])
            budget -= out[k]
        open_ = [k for k in open_ if k not in set(full)]
    return out


def fit(budget: int, counts: dict[int, int]) -> dict[int, int]:
    """How many documents of each length to take so that their words come nearest ``budget``.

    All but a rest of the budget is filled by every length's proportional share, rounded down,
    and then by long lengths.  The rest is at least ``EXACT_WORDS`` and four times the longest
    document, so that one more long document, going over the budget, is weighed against many
    short ones.  A bounded knapsack over the documents left finds the sum nearest to the rest,
    not exceeding it where two are equally near; a budget that isn't larger than the rest is so
    fitted as well as it can be.  Where the rest and the longest document are beyond ``CELLS``
    words, lengths count in units, at most one part in ``CELLS`` of it each.
    """
    total = sum(n * c for n, c in counts.items())
    if budget <= 0 or not total:
        return {}
    if budget >= total:
        return dict(counts)
    longest = max(counts)
    rest = max(EXACT_WORDS, 4 * longest)
    rough = max(0, budget - rest)
    taken = {n: c * rough // total for n, c in counts.items()}
    left = budget - sum(n * c for n, c in taken.items())
    for n in sorted(counts, reverse=True):
        if left <= rest:
            break
        more = min(counts[n] - taken[n], -(-(left - rest) // n), left // n)
        taken[n] += more
        left -= more * n
    for n, more in _nearest(left, {n: c - taken[n] for n, c in counts.items()}, longest).items():
        taken[n] += more
    return taken


def _nearest(goal: int, spare: dict[int, int], longest: int) -> dict[int, int]:
    """Documents of ``spare`` whose words come nearest ``goal``: bounded knapsack by batches of 1, 2,
    4, ... documents of a length.  A cell holds the first batch that made its sum."""
    unit = -(-(goal + longest) // CELLS)
    top, aim = (goal + longest) // unit, goal // unit if unit == 1 else round(goal / unit)
    first = np.full(top + 1, -1, np.int32)
    first[0] = 0
    steps = [(0, 0, 0)]
    for n in sorted(spare):
        width = round(n / unit)
        left, batch = min(spare[n], top // max(width, 1)), 1
        while left > 0 and width and first[aim] < 0:
            batch = min(batch, left)
            move = width * batch
            if move > top:
                break
            new = np.flatnonzero((first[:-move] >= 0) & (first[move:] < 0)) + move
            first[new] = len(steps)
            steps.append((n, batch, move))
            left -= batch
            batch *= 2
        if first[aim] >= 0:
            break
    made = np.flatnonzero(first >= 0)
    at = int(made[np.argmin(np.abs(made - aim))])
    out: dict[int, int] = {}
    while at:
        n, batch, move = steps[first[at]]
        out[n] = out.get(n, 0) + batch
        at -= move
    return out


def _planned(goals: dict[str | None, tuple[int, float, int, int]]):
    """Per source the number of whole passes and of further documents of each length."""

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        name = group["source"].iloc[0]
        total, target, passes, rest = goals[None if pd.isna(name) else name]
        counts = {int(n): int(c) for n, c in zip(group["size"], group["n"]) if n}
        extra = fit(rest, counts)
        return pd.DataFrame(
            {"source": group["source"], "size": group["size"], "source_size": total, "target": target, "passes": passes}
            | {"extra": [extra.get(int(n), 0) for n in group["size"]]}
        )

    return plan


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix(docs: DataFrame, seed: int = 17, share: float = 1.0, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """``doc_id, _key, size, source_size, target, taken, times`` for every row.

    Sources (by code point, NULL last) get targets by :func:`targets`.  A source is taken
    whole as often as its target allows; what then remains of the target is fitted by
    :func:`fit` over the numbers of documents per length, and of each length the documents
    that come first by a seeded hash are taken once more.  ``taken`` is ``times`` times the
    size.  NULL and blank texts have size 0 and are taken as often as their source is whole.
    Reruns agree; of rows and lengths that tie, the smaller doc_id goes first; repeated rows are
    taken one by one; a very long text is weighed like any other; an empty table gives no rows;
    other columns are ignored.  Source totals (one row per source) and lengths per source (bounded
    by the longest text) are the only things that meet in one place.
    """
    key = row_key(F.coalesce("text", F.lit("")))
    rows = stored(docs.select("doc_id", key.alias("_key"), "source", word_count(F.col("text")).alias("size")))
    lengths = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total")).collect()
    totals = sorted(((r[0], int(r[1])) for r in totals), key=lambda r: (r[0] is None, r[0] or ""))
    wanted = targets([n for _, n in totals], share, weights, most)
    goals = {}
    for (name, total), target in zip(totals, wanted):
        passes = int(target // total) if total else 0
        goals[name] = (total, float(target), passes, round(target - passes * total))
    plan = stored(lengths.groupBy("source").applyInPandas(_planned(goals), PLAN))
    # The place of a row among those of its source and length, in seeded order.
    order = placed(rows.withColumn("_lot", F.xxhash64(F.lit(seed), "doc_id", "_key")), F.col("source"), F.col("size"), F.col("_lot"), F.col("doc_id"))
    firsts = order.groupBy(F.col("source").alias("_s"), F.col("size").alias("_n")).agg(F.min("pos").alias("_first"))
    chosen = firsts.join(plan, F.col("_s").eqNullSafe(F.col("source")) & (F.col("_n") == F.col("size"))).select("_s", "_n", "_first", "source_size", "target", "passes", "extra")
    joined = order.join(chosen, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n")))
    times = F.col("passes") + (F.col("pos") < F.col("_first") + F.col("extra")).cast("long")
    return joined.select(
        "doc_id", "_key", "source", "size", "source_size", "target", (times * F.col("size")).alias("taken"), times.alias("times")
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows and columns of ``docs``, each row as often as :func:`mix` takes it.

    Rows equal in doc_id and text are alike, so what :func:`mix` takes of them all is dealt to
    them evenly, the remainder once each to as many of them; no word is lost or added by that.
    """
    taken = mix(docs, **how).groupBy("doc_id", "_key").agg(F.sum("times").alias("_all"), F.count(F.lit(1)).alias("_n"))
    taken = taken.where("_all > 0").select(F.col("doc_id").alias("_d2"), F.col("_key").alias("_k2"), "_all", "_n")
    key = row_key(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_d"), key.alias("_k"))
    met = rows.join(taken, F.col("_d").eqNullSafe(F.col("_d2")) & (F.col("_k") == F.col("_k2"))).drop("_d2", "_k2")
    times = F.expr("_all div _n")
    even = met.where("_all % _n = 0").select("_row", times.alias("_times"))
    # The others are numbered within their group, which is spread over tasks by a random-like lot.
    uneven = met.where("_all % _n > 0").withColumn("_lot", F.xxhash64(F.monotonically_increasing_id()))
    order = placed(uneven, F.col("_k"), F.col("_d"), F.col("_lot"))
    firsts = order.groupBy(F.col("_k").alias("_k2"), F.col("_d").alias("_d2")).agg(F.min("pos").alias("_first"))
    numbered = order.join(firsts, (F.col("_k") == F.col("_k2")) & F.col("_d").eqNullSafe(F.col("_d2")))
    more = (F.col("pos") - F.col("_first") < F.col("_all") % F.col("_n")).cast("long")
    dealt = even.union(numbered.select("_row", (times + more).alias("_times"))).where("_times > 0")
    return dealt.withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select("_row.*")
