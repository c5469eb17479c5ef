"""Exact interpolated quantiles without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_PER_OCTAVE = 64


def exact_quantiles(
    df: DataFrame, columns: Mapping[str, Column], probs: Iterable[float]
) -> DataFrame:
    """Quantiles of the positive values of each column: ``column, prob, total, value``.

    Linear interpolation between the two neighbouring ranks.  Values are counted first
    (map-side combine, so a very common value costs nothing), counts are summed into
    logarithmic bins whose number is bounded by the range of a double, and only the one
    or two bins holding a wanted rank are ordered.
    """
    probs = list(probs)
    entries = F.array(
        *(F.struct(F.lit(n).alias("column"), c.cast("double").alias("value")) for n, c in columns.items())
    )
    hist = (
        df.select(F.inline(entries))
        .where(F.col("value") > 0)
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin", F.floor(F.log2("value") * BINS_PER_OCTAVE))
        # The join below asks for it; asked for here, both readers of the counts share one shuffle.
        .where(F.col("bin").isNotNull())
    )
    per_bin = hist.groupBy("column", "bin").agg(F.sum("n").alias("bin_n"))

    by_column = Window.partitionBy("column")
    position = F.col("prob") * (F.col("total") - 1)
    wanted = (
        per_bin.select(
            "column",
            "bin",
            "bin_n",
            (F.sum("bin_n").over(by_column.orderBy("bin")) - F.col("bin_n")).alias("before"),
            F.sum("bin_n").over(by_column).alias("total"),
        )
        .withColumn("prob", F.explode(F.array(*(F.lit(float(p)) for p in probs))))
        .withColumn("low", F.floor(position))
        .withColumn("high", F.ceil(position))
        .withColumn("part", position - F.col("low"))
        .where(
            (F.col("high") >= F.col("before"))
            & (F.col("low") < F.col("before") + F.col("bin_n"))
        )
    )
    # At most two bins per column and probability, so this side is bounded by construction.
    inside = hist.join(F.broadcast(wanted), ["column", "bin"])
    in_order = Window.partitionBy("column", "prob", "bin").orderBy("value")
    reached = F.col("before") + F.sum("n").over(in_order)
    ranked = inside.withColumn("upto", reached)
    a, b, t = F.col("a"), F.col("b"), F.col("part")
    return (
        ranked.groupBy("column", "prob", "total", "part")
        .agg(
            F.min(F.when(F.col("upto") > F.col("low"), F.col("value"))).alias("a"),
            F.min(F.when(F.col("upto") > F.col("high"), F.col("value"))).alias("b"),
        )
        .select(
            "column",
            "prob",
            "total",
            F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t)).alias("value"),
        )
    )


def quantile_row(df: DataFrame, columns: Mapping[str, Column], prob: float) -> Column:
    """One struct field per column, as a scalar subquery (no join, no collect)."""
    found = exact_quantiles(df, columns, [prob])
    return found.agg(
        F.struct(
            *(F.max(F.when(F.col("column") == n, F.col("value"))).alias(n) for n in columns)
        ).alias("q")
    ).scalar()
