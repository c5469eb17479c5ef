"""Where every source row went: excluded rows with their rule, and the books of each table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V

ROW = [V.SOURCE_FILE, V.SOURCE_ROW]
KEPT = [f"kept_{c}" for c in ROW]
EXCLUDED = ("table", *ROW, "row_key", "rule", "iteration", *KEPT)


def excluded(rows: DataFrame, table: str, rule: str | Column, iteration: int = 0) -> DataFrame:
    """Rows lost to a rule in one shape.

    ``iteration`` is the validation pass, 0 before the first.  A row that another one stands
    for names that row in ``kept_source_file`` and ``kept_source_row_num``.
    """
    rule = F.lit(rule) if isinstance(rule, str) else rule
    kept = [F.col(c) if c in rows.columns else F.lit(None).cast(rows.schema[s].dataType).alias(c) for c, s in zip(KEPT, ROW)]
    return rows.select(
        F.lit(table).alias("table"),
        *ROW,
        F.col("id").cast("string").alias("row_key"),
        rule.alias("rule"),
        F.lit(iteration).alias("iteration"),
        *kept,
    )


def row_accounting(given: dict[str, DataFrame], kept: dict[str, DataFrame], excluded: DataFrame) -> DataFrame:
    """One row per table: its source rows against those kept and excluded.

    Every source row has to be either kept or excluded, once.  ``merged_rows`` are the excluded
    ones that a kept row stands for, ``lost_rows`` are in neither, ``doubled_rows`` in more than
    one place, ``stray_rows`` aren't source rows or name a row that isn't kept.
    The sides meet by table, file and row number; what is added up before, so a row that repeats costs nothing.
    """
    def side(rows: DataFrame, table: Column, **marks: Column) -> DataFrame:
        zero = F.lit(0).cast("long")
        flags = {k: marks.get(k, zero).cast("long").alias(k) for k in ("given", "kept", "excluded", "merged", "named")}
        return rows.select(table.alias("table"), *ROW, *flags.values())

    one = F.lit(1)
    merged = F.col(KEPT[1]).isNotNull()
    named = excluded.where(merged).select("table", *(F.col(k).alias(c) for k, c in zip(KEPT, ROW)))
    books = side(excluded, F.col("table"), excluded=one, merged=merged.cast("int")).union(
        side(named, F.col("table"), named=one)
    )
    for table in given:
        books = books.union(side(given[table], F.lit(table), given=one)).union(side(kept[table], F.lit(table), kept=one))
    rows = books.groupBy("table", *ROW).agg(*(F.sum(c).alias(c) for c in ("given", "kept", "excluded", "merged", "named")))
    stray = (F.col("given") == 0) | ((F.col("named") > 0) & (F.col("kept") == 0))
    totals = rows.groupBy("table").agg(
        F.sum("given").alias("input_rows"),
        F.sum("kept").alias("kept_rows"),
        F.sum("excluded").alias("excluded_rows"),
        F.sum("merged").alias("merged_rows"),
        F.count_if((F.col("given") > 0) & (F.col("kept") + F.col("excluded") == 0)).alias("lost_rows"),
        F.count_if((F.col("given") > 1) | (F.col("kept") + F.col("excluded") > 1)).alias("doubled_rows"),
        F.count_if(stray).alias("stray_rows"),
    )
    wrong = F.col("lost_rows") + F.col("doubled_rows") + F.col("stray_rows")
    return totals.withColumn("balanced", (wrong == 0) & (F.col("input_rows") == F.col("kept_rows") + F.col("excluded_rows")))
