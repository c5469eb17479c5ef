"""Repairs of item prices, as projections, filters and one join back to the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.operators.skew import join_groups

ROW = [V.SOURCE_FILE, V.SOURCE_ROW]
PAIR = ["menu_page_id", "dish_id"]
DIGITS = 9


def repair_zero_prices(items: DataFrame) -> DataFrame:
    """A zero price takes the high price, becomes NULL without one, or drops the row if both are zero."""
    price, high = F.col("price"), F.col("high_price")
    zero = F.coalesce(price == 0, F.lit(False))
    hopeless = zero & F.coalesce(high == 0, F.lit(False))
    return items.where(~hopeless).withColumn("price", F.when(zero, high).otherwise(price))


def mean_of_distinct(column: str) -> Column:
    """``AVG(DISTINCT x)`` rounded to nine decimals, so that no order of rows changes a digit."""
    return F.round(F.sum_distinct(F.col(column)) / F.count_distinct(column), DIGITS)


def _priced_groups(items: DataFrame, price: str) -> DataFrame:
    """(page, dish) groups that need work: several prices (``conflict``), or one beside blanks."""
    priced = F.col(price).isNotNull()
    return (
        items.where(F.col("dish_id").isNotNull())
        .groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count(price).alias("priced"),
            F.min(price).alias("low"),
            F.max(price).alias("top"),
            F.min(F.when(priced, F.col("id"))).alias("keep_id"),
        )
        .where("low < top or (low = top and lines > priced)")
        .select(*PAIR, "lines", "keep_id", F.expr("low < top").alias("conflict"))
    )


def repair_price_conflicts(items: DataFrame) -> DataFrame:
    """Collapse differently priced duplicates, then drop blanks beside a single price.

    A (page, dish) group with several prices keeps the row with the smallest id among its
    priced rows, priced at the mean of the distinct prices; a group with one price loses
    its unpriced rows.  Minimum and maximum tell the two apart in one plain aggregate;
    distinct means are taken only inside conflicting groups.  Groups with a NULL page are
    priced but lose no row, as a row-value comparison never matches NULL.
    """
    columns = items.columns
    priced = F.col("price").isNotNull()
    groups = _priced_groups(items, "price")
    tagged = join_groups(items, groups, PAIR, "lines")
    conflict = F.coalesce(F.col("conflict"), F.lit(False))
    known_page = F.col("menu_page_id").isNotNull()
    blank_beside_price = F.col("conflict").isNotNull() & ~conflict & ~priced & known_page

    others = [c for c in columns if c not in (*PAIR, "id", "price", "high_price")]
    kept_row = F.min_by(F.struct("id", *others), "id").alias("row")
    kept = (
        tagged.where(conflict & priced)
        .groupBy(*PAIR)
        .agg(
            kept_row,
            mean_of_distinct("price").alias("price"),
            mean_of_distinct("high_price").alias("high_price"),
        )
        .select("row.*", *PAIR, "price", "high_price")
        .select(*columns)
    )
    gone = (conflict & (known_page | (F.col("id") == F.col("keep_id")))) | blank_beside_price
    return tagged.where(~gone).select(*columns).unionByName(kept)


def repair_items(items: DataFrame) -> DataFrame:
    """All repairs in their order."""
    return repair_price_conflicts(repair_zero_prices(items))


def repair_ledger(items: DataFrame, row: list[str] = ROW) -> DataFrame:
    """Every row of ``items`` with what the repairs do to it; ``row`` tells rows apart.

    ``rule`` is the last one that applies, NULL for a row that stays as it is: D1 (a zero price
    takes the high price), D2 (becomes NULL), D3 (removed, both are zero), D4 (conflicting
    prices: one row stays with the mean of the distinct prices, the others go) or D5 (removed, a
    blank beside a single price).  ``removed`` tells whether the row goes, ``kept_<row>`` which
    row then stands for it (D4 only), ``new_price`` and ``new_high_price`` what it holds after.
    """
    price, high = F.col("price"), F.col("high_price")
    zero = F.coalesce(price == 0, F.lit(False))
    rule = F.when(zero & (high == 0), "D3").when(zero & high.isNotNull(), "D1").when(zero, "D2")
    judged = items.withColumns({"rule": rule, "new_price": F.when(zero, high).otherwise(price), "new_high_price": high})
    hopeless = F.coalesce(F.col("rule") == "D3", F.lit(False))
    tagged = join_groups(
        judged.where(~hopeless), _priced_groups(judged.where(~hopeless), "new_price").drop("keep_id"), PAIR, "lines"
    )
    conflict = F.coalesce(F.col("conflict"), F.lit(False))
    known_page = F.col("menu_page_id").isNotNull()
    first = F.min(F.struct(F.col("id").isNull().alias("_none"), "id", *row)).alias("_keep")
    means = tagged.where(conflict & F.col("new_price").isNotNull()).groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("_n"),
        first,
        mean_of_distinct("new_price").alias("_price"),
        mean_of_distinct("new_high_price").alias("_high"),
    )
    none = [F.lit(None).cast(items.schema[c].dataType).alias(f"kept_{c}") for c in row]
    blank = F.col("conflict").isNotNull() & F.col("new_price").isNull() & known_page
    columns = [*items.columns, "new_price", "new_high_price"]
    alone = tagged.where(~conflict).select(
        *columns, F.when(blank, "D5").otherwise(F.col("rule")).alias("rule"), blank.alias("removed"), *none
    )
    met = join_groups(tagged.where(conflict), means, PAIR, "_n")
    stays = F.struct(*row).eqNullSafe(F.struct(*(F.col(f"_keep.{c}").alias(c) for c in row)))
    goes = ~stays & known_page
    merged = met.select(
        *items.columns,
        F.when(stays, F.col("_price")).otherwise(F.col("new_price")).alias("new_price"),
        F.when(stays, F.col("_high")).otherwise(F.col("new_high_price")).alias("new_high_price"),
        F.when(stays | goes, "D4").otherwise(F.col("rule")).alias("rule"),
        goes.alias("removed"),
        *(F.when(goes, F.col(f"_keep.{c}")).alias(f"kept_{c}") for c in row),
    )
    hopeless_rows = judged.where(hopeless).select(*columns, "rule", F.lit(True).alias("removed"), *none)
    return alone.unionByName(merged).unionByName(hopeless_rows)


def after_repair(ledger: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that stay, with their new prices."""
    new = {"price": F.col("new_price").alias("price"), "high_price": F.col("new_high_price").alias("high_price")}
    return ledger.where(~F.col("removed")).select(*(new.get(c, F.col(c)) for c in columns))
