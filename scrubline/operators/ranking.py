"""Ranks within groups of any size, and top rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.sources.workspace import Workspace


def ranked(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Add ``rank_in_group`` (1-based) and ``group_rows`` without a task per group.

    Rows are range-partitioned and sorted by group and order, and written with their partition
    and place, so that both passes below see the same even after an executor is lost.  Each partition
    then counts its rows per group; a row's rank is its place in the partition plus the
    counts of the same group in earlier partitions.  ``order`` must end in a unique column.
    """
    columns = df.columns
    sorted_rows = df.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    placed = Workspace(df.sparkSession).table(
        "ranked",
        lambda: sorted_rows.select(
            *columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq")
        ),
    )
    in_group = Window.partitionBy(group)
    # Sorted by group, so there are at most (partitions + groups) of these rows.
    offsets = (
        placed.groupBy(group, "_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
        .select(
            F.col(group).alias("_group"),
            F.col("_part").alias("_at"),
            "_first",
            (F.sum("_n").over(in_group.orderBy("_part")) - F.col("_n")).alias("_before"),
            F.sum("_n").over(in_group).alias("group_rows"),
        )
    )
    same = (F.col(group).eqNullSafe(F.col("_group"))) & (F.col("_part") == F.col("_at"))
    return placed.join(offsets, same).select(
        *columns,
        (F.col("_before") + F.col("_seq") - F.col("_first") + 1).alias("rank_in_group"),
        "group_rows",
    )


def tile(buckets: int) -> Column:
    """``NTILE`` from rank and group size: the first ``rows % buckets`` tiles hold one more."""
    rank0, rows = F.col("rank_in_group") - 1, F.col("group_rows")
    size, extra = F.floor(rows / buckets), rows % buckets
    in_big = rank0 < extra * (size + 1)
    return F.when(in_big, F.floor(rank0 / (size + 1)) + 1).otherwise(
        extra + F.floor((rank0 - extra * (size + 1)) / F.greatest(size, F.lit(1))) + 1
    ).cast("int")


def top_rows(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows per group with their ``position``; each task forwards at most ``k`` per group."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("position", place).where(F.col("position") <= k)
