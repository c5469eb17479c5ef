"""Column profiles and health counts, one aggregate per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.functions.cleaners import NUMBER
from scrubline.functions.unicode import LETTER_OR_DIGIT, strip_spaces

METRICS = (
    "rows",
    "missing",
    "blank",
    "malformed",
    "zero",
    "negative",
    "distinct_values",
    "symbol_only",
    "numeric_only",
    "low",
    "high",
)


def _unpivot(row: DataFrame, table: str, columns: list[str], metrics: tuple[str, ...]) -> DataFrame:
    lines = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(c).alias("column"),
            *(F.col(f"{c}__{m}").alias(m) for m in metrics),
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*lines)))


def profile(df: DataFrame, table: str, numeric: tuple[str, ...] = ()) -> DataFrame:
    """Counts per column of a raw text table: absence, malformed or odd values, range.

    ``numeric`` names the columns read as numbers; malformed, zero and negative are zero
    for the others.  Cells are counted per (column, value) first, so patterns are matched
    once per distinct value and a value held by many rows is combined where it is read.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in df.columns))
    values = df.select(F.inline(cells)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    judged = values.select(
        "column",
        "value",
        "n",
        strip_spaces(F.col("value")).alias("text"),
        F.col("column").isin(*numeric).alias("numeric") if numeric else F.lit(False).alias("numeric"),
    ).select(
        "*",
        (F.col("value").isNull() | F.col("text").isin(*V.NULL_TOKENS)).alias("missing"),
        F.when(F.col("numeric") & F.col("text").rlike(NUMBER), F.col("text"))
        .try_cast("double")
        .alias("number"),
    )
    present = ~F.col("missing")
    measured = judged.select(
        "column",
        "n",
        "value",
        F.when(present, F.col("text")).alias("shown"),
        F.col("missing").alias("missing"),
        (F.col("text") == "").alias("blank"),
        (F.col("numeric") & present & F.col("number").isNull()).alias("malformed"),
        (F.col("number") == 0).alias("zero"),
        (F.col("number") < 0).alias("negative"),
        (present & ~F.col("text").rlike(LETTER_OR_DIGIT)).alias("symbol_only"),
        (present & F.col("text").rlike("^[0-9]+$")).alias("numeric_only"),
    )
    # The least and greatest text in a grouped aggregate would sort all values by column first;
    # one aggregate without groups holds a row of buffers per task.
    measures = []
    for c in df.columns:
        here = F.col("column") == c

        def rows_where(flag: str) -> Column:
            return F.sum(F.when(here & F.col(flag), F.col("n")).otherwise(0)).alias(f"{c}__{flag}")

        measures += [
            F.sum(F.when(here, F.col("n"))).alias(f"{c}__rows"),
            *(rows_where(flag) for flag in ("missing", "blank", "malformed", "zero", "negative")),
            F.count(F.when(here, F.col("value"))).alias(f"{c}__distinct_values"),
            *(rows_where(flag) for flag in ("symbol_only", "numeric_only")),
            F.min(F.when(here, F.col("shown"))).alias(f"{c}__low"),
            F.max(F.when(here, F.col("shown"))).alias(f"{c}__high"),
        ]
    return _unpivot(measured.agg(*measures), table, df.columns, METRICS).where("rows is not null")


def id_health(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows, NULLs and distinct values of identifier columns."""
    measures = []
    for c in columns:
        measures += [
            F.count(F.lit(1)).alias(f"{c}__rows"),
            F.count_if(F.col(c).isNull()).alias(f"{c}__null_rows"),
            F.count_distinct(F.col(c)).alias(f"{c}__distinct_values"),
        ]
    return _unpivot(df.agg(*measures), table, list(columns), ("rows", "null_rows", "distinct_values"))


def price_health(df: DataFrame, table: str, low: str, high: str) -> DataFrame:
    """Missing, non-positive and positive counts of a price pair, plus its contradictions."""
    pair = {c: F.col(c).try_cast("double") for c in (low, high)}
    measures = []
    for c, number in pair.items():
        measures += [
            F.count_if(number.isNull()).alias(f"{c}__missing"),
            F.count_if(number <= 0).alias(f"{c}__non_positive"),
            F.count_if(number > 0).alias(f"{c}__positive"),
            F.count_if(pair[high] < pair[low]).alias(f"{c}__contradictory"),
            F.count_if((pair[low] > 0) & (pair[high] > 0)).alias(f"{c}__both_positive"),
        ]
    metrics = ("missing", "non_positive", "positive", "contradictory", "both_positive")
    return _unpivot(df.agg(*measures), table, list(pair), metrics)


def name_collapse(raw: DataFrame, cleaned: DataFrame, column: str = "name") -> DataFrame:
    """Distinct values before and after cleaning, and how many rows became UNKNOWN."""
    before = raw.agg(F.count_distinct(column).alias("n")).scalar()
    return cleaned.agg(
        F.count_distinct(column).alias("distinct_after"),
        F.count_if(F.col(column) == V.UNKNOWN_NAME).alias("unknown"),
    ).select(
        before.alias("distinct_before"),
        "distinct_after",
        (before - F.col("distinct_after")).alias("collapsed"),
        "unknown",
    )
