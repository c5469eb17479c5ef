"""Joining per-group results back to rows when one group may hold much of the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_GROUPS = 1000


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys (a NULL group is a group)."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "left"
) -> DataFrame:
    """Join one-row-per-group results to the rows of those groups, safe for hot groups.

    A group holding more than 1/1000 of all grouped rows is hot; there are at most 1000 of
    these whatever the data, so their results are broadcast and their rows never meet in
    one task.  Rows of hot groups carry a random-like salt through the second join, where
    the other groups are matched by an ordinary shuffle.  Keys compare null-safe.
    """
    payload = [c for c in groups.columns if c not in keys]
    # Filtering on a scalar subquery of the same aggregate keeps the plan lazy.
    total = groups.agg(F.sum(size)).scalar()
    is_hot = F.col(size) * HOT_GROUPS > total

    def side(part: DataFrame, tag: str) -> DataFrame:
        return part.select(
            *(F.col(k).alias(f"_{tag}_{k}") for k in keys),
            F.struct(*payload).alias(f"_{tag}"),
        )

    def match(tag: str) -> Column:
        return reduce(
            lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{tag}_{k}")) for k in keys)
        )

    hot = F.broadcast(side(groups.where(is_hot), "hot"))
    cold = side(groups.where(~is_hot), "cold").withColumn("_cold_salt", F.lit(0).cast("bigint"))
    salted = (
        rows.join(hot, match("hot"), "left")
        .withColumn(
            "_salt",
            F.when(F.col("_hot").isNotNull(), F.xxhash64(*rows.columns)).otherwise(F.lit(0)),
        )
    )
    joined = salted.join(cold, match("cold") & (F.col("_salt") == F.col("_cold_salt")), "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    if how == "left_semi":
        return joined.where(found.isNotNull()).select(*rows.columns)
    out = joined.where(found.isNotNull()) if how == "inner" else joined
    return out.select(*rows.columns, *(found[c].alias(c) for c in payload))
