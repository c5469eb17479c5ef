"""Key-collision clusters of text variants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.operators.skew import join_groups


def variants(df: DataFrame, value: str, key: Callable[[Column], Column]) -> DataFrame:
    """Distinct values with their row count and key; the key is made once per distinct value."""
    values = df.groupBy(F.col(value).alias("variant")).agg(F.count(F.lit(1)).alias("variant_rows"))
    return values.select(key(F.col("variant")).alias("cluster_key"), "variant", "variant_rows")


def clusters(found: DataFrame) -> DataFrame:
    """Keys with several variants, their counts, and the most frequent variant as suggestion."""
    best = F.max_by("variant", F.struct("variant_rows", "variant"))
    return (
        found.groupBy("cluster_key")
        .agg(
            F.count(F.lit(1)).alias("variants"),
            F.sum("variant_rows").alias("cluster_rows"),
            best.alias("suggested"),
        )
        .where("variants > 1")
    )


def cluster_members(found: DataFrame) -> DataFrame:
    """Every variant of every cluster, one row each, however large the cluster."""
    sizes = clusters(found)
    return join_groups(found, sizes, ["cluster_key"], "variants", "inner")


# --- accepted merges --------------------------------------------------------
def accepted_merges(members: DataFrame, method: str) -> DataFrame:
    """``variant, canonical, cluster_id, method``: each cluster's variants go to its suggestion."""
    return members.where("variant <> suggested").select(
        "variant",
        F.col("suggested").alias("canonical"),
        F.concat(F.lit(f"{method}:"), F.col("cluster_key")).alias("cluster_id"),
        F.lit(method).alias("method"),
    )


def resolve_merges(links: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Links with ``canonical`` replaced by the end of their chain: A to B and B to C make A to C.

    Of several links of a variant the one with the smallest canonical value counts.  Values that
    are linked in a circle all go to the smallest of them.  Each round doubles the steps taken,
    so rounds grow with the logarithm of the longest chain; every round is written.
    """
    one = F.min(F.struct("canonical", "cluster_id", "method")).alias("link")
    first = links.where("variant <> canonical").groupBy("variant").agg(one).select("variant", "link.*")
    first = store(first, "merges")
    total = first.count()
    # low: the smallest value on the way to target, the variant included.
    now = first.select("variant", F.col("canonical").alias("target"), F.least("variant", "canonical").alias("low"))
    steps = 1

    def ahead(of: DataFrame) -> DataFrame:
        return of.select(F.col("variant").alias("_at"), F.col("target").alias("_next"), F.col("low").alias("_low"))

    open_ = now.join(ahead(now), F.col("target") == F.col("_at"), "left_semi")
    while steps <= total and not open_.isEmpty():
        met = now.join(ahead(now), F.col("target") == F.col("_at"), "left")
        steps *= 2
        now = store(
            met.select(
                "variant",
                F.coalesce("_next", "target").alias("target"),
                F.least("low", F.coalesce("_low", "low")).alias("low"),
            ),
            f"merges_{steps}",
        )
        open_ = now.join(ahead(now), F.col("target") == F.col("_at"), "left_semi")
    # A target that still leads on lies in a circle, all of which it has passed.
    ended = now.join(ahead(now), F.col("target") == F.col("_at"), "left").select(
        "variant", F.coalesce("_low", "target").alias("end")
    )
    return first.join(ended, "variant").where("variant <> end").select("variant", F.col("end").alias("canonical"), "cluster_id", "method")


def apply_merges(rows: DataFrame, column: str, merges: DataFrame) -> DataFrame:
    """``rows`` with ``merged``, the canonical form of ``column``, and the ``cluster_id`` that
    changed it, NULL where it stays.  A value that many rows hold is joined without meeting them
    in one task."""
    held = rows.groupBy(F.col(column).alias("variant")).agg(F.count(F.lit(1)).alias("_rows"))
    groups = merges.join(held, "variant").select(F.col("variant").alias(column), "canonical", "cluster_id", "_rows")
    met = join_groups(rows, groups, [column], "_rows")
    return met.select(*rows.columns, F.coalesce("canonical", column).alias("merged"), "cluster_id")


def merge_effect(rows: DataFrame, column: str, merges: DataFrame) -> DataFrame:
    """Per accepted cluster: method, canonical value, merged variants and rows that change."""
    held = rows.groupBy(F.col(column).alias("variant")).agg(F.count(F.lit(1)).alias("_rows"))
    return merges.join(held, "variant", "left").groupBy("cluster_id", "method", "canonical").agg(
        F.count(F.lit(1)).alias("merged_variants"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_affected")
    )
