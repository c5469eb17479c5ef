"""Opt-in estimates from sketches that are built where rows are read, stored and merged.

A sketch answers for all rows that went into it and into those it was merged with, whatever
files, tables or runs they came from.  Exact results are the default elsewhere; these are for
columns whose counts or order would cost too much to keep.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a quantile sketch, and the share of rows that an estimate's rank may be off by.  The
#: expected error at this size is about 0.2 %.
QUANTILE_SIZE = 1600
RANK_BOUND = 0.01
#: Logarithm of a distinct sketch's registers, and the relative bound: four times its standard error of 0.8 %.
DISTINCT_SIZE = 14
DISTINCT_BOUND = 0.033


def _cells(df: DataFrame, columns: Mapping[str, Column], by: list[str]) -> DataFrame:
    cells = F.array(*(F.struct(F.lit(n).alias("column"), c.alias("value")) for n, c in columns.items()))
    return df.select(*by, F.inline(cells))


def quantile_sketches(df: DataFrame, columns: Mapping[str, Column], by: list[str]) -> DataFrame:
    """``by, column, sketch`` over the positive values of each column."""
    cells = _cells(df, {n: c.cast("double") for n, c in columns.items()}, by)
    return cells.where("value > 0").groupBy(*by, "column").agg(
        F.kll_sketch_agg_double("value", F.lit(QUANTILE_SIZE)).alias("sketch")
    )


def merged_quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(QUANTILE_SIZE)).alias("sketch"))


def estimated_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """One row per sketch and probability: ``prob, total, estimate``."""
    found = F.array(
        *(F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("estimate")) for p in probs)
    )
    rows = sketches.withColumns({"total": F.kll_sketch_get_n_double("sketch"), "_found": found})
    return rows.select(*(c for c in rows.columns if c not in ("sketch", "_found")), F.inline("_found"))


def rank_errors(df: DataFrame, columns: Mapping[str, Column], estimates: DataFrame) -> DataFrame:
    """``column, prob, total, rank_error``: how far the rows below and up to an estimate are from its
    probability, as a share of all rows; zero if it lies among equal values that cover it."""
    cells = _cells(df, {n: c.cast("double") for n, c in columns.items()}, []).where("value > 0")
    counted = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # One row per column and probability.
    met = counted.join(F.broadcast(estimates.select("column", "prob", "total", "estimate")), "column")
    sums = met.groupBy("column", "prob", "total").agg(
        F.sum(F.when(F.col("value") < F.col("estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("estimate"), F.col("n")).otherwise(0)).alias("upto"),
    )
    off = F.greatest(F.col("below") / F.col("total") - F.col("prob"), F.col("prob") - F.col("upto") / F.col("total"), F.lit(0.0))
    return sums.select("column", "prob", "total", off.alias("rank_error"))


def distinct_sketches(df: DataFrame, columns: Mapping[str, Column], by: list[str]) -> DataFrame:
    """``by, column, sketch`` over the values of each column as text, NULL left out."""
    cells = _cells(df, {n: c.cast("string") for n, c in columns.items()}, by)
    return cells.groupBy(*by, "column").agg(F.hll_sketch_agg("value", F.lit(DISTINCT_SIZE)).alias("sketch"))


def united(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_distinct(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("estimate", F.hll_sketch_estimate("sketch")).drop("sketch")


def save_run(sketches: DataFrame, path: str, run: str) -> None:
    """Keep the sketches of one run beside those of others; the same run again replaces itself."""
    sketches.write.mode("overwrite").parquet(f"{path}/run={run}")


def saved_runs(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all runs, with ``run``."""
    return spark.read.option("basePath", path).parquet(f"{path}/run=*")
