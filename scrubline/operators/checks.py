"""Constraint checks; each returns the violating rows, so an empty result means it holds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.operators.skew import join_groups



# --- integrity --------------------------------------------------------------
def stored_type(df: DataFrame, column: str) -> Column:
    """What a value is stored as: null, integer, real or text."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind == "string":
        named = (
            F.when(value.try_cast("bigint").isNotNull(), "integer")
            .when(value.try_cast("double").isNotNull(), "real")
            .otherwise("text")
        )
    else:
        named = F.lit("integer" if kind in ("integer", "long", "short", "byte") else "real")
    return F.when(value.isNull(), "null").otherwise(named)


def _outside(column: str, low: int, high: int) -> Callable[[DataFrame], Column]:
    def predicate(df: DataFrame) -> Column:
        value = F.col(column).try_cast("double")
        return (
            F.col(column).isNull()
            | (stored_type(df, column) != "integer")
            | ~value.between(low, high)
        )

    return predicate


def _missing(column: str) -> Callable[[DataFrame], Column]:
    return lambda df: F.col(column).isNull()


@dataclass(frozen=True)
class IntegrityRule:
    """A row predicate that must never hold."""

    rule_id: str
    table: str
    violation: str
    columns: tuple[str, ...]
    predicate: Callable[[DataFrame], Column]
    typed: bool = False

    def violations(self, df: DataFrame) -> DataFrame:
        shown = [F.col(c) for c in ("id", *self.columns)]
        if self.typed:
            shown.append(stored_type(df, self.columns[0]).alias("stored_type"))
        return df.where(self.predicate(df)).select(
            F.lit(self.rule_id).alias("rule_id"), *shown, F.lit(self.violation).alias("violation")
        )


def _price_band(column: str, high: int) -> Callable[[DataFrame], Column]:
    return lambda df: F.col(column).isNull() | (F.col(column) < 0) | (F.col(column) > high)


INTEGRITY_RULES: tuple[IntegrityRule, ...] = (
    IntegrityRule("IC-1", "menu", "Menu.id is required", (), _missing("id")),
    IntegrityRule(
        "IC-2",
        "menu",
        "currency must be USD",
        ("currency",),
        lambda df: F.col("currency").isNull() | (F.col("currency") != V.CHECK_CURRENCY),
    ),
    IntegrityRule(
        "IC-3",
        "menu",
        "year must be an integer between 1851 and 2012",
        ("year",),
        _outside("year", V.CHECK_MIN_YEAR, V.CHECK_MAX_YEAR),
        True,
    ),
    IntegrityRule(
        "IC-4", "menu", "month must be an integer between 1 and 12", ("month",), _outside("month", 1, 12), True
    ),
    IntegrityRule(
        "IC-5", "menu", "day must be an integer between 1 and 31", ("day",), _outside("day", 1, 31), True
    ),
    IntegrityRule("IC-6", "menu_item", "MenuItem.id is required", (), _missing("id")),
    IntegrityRule(
        "IC-7", "menu_item", "MenuItem.menu_page_id is required", ("menu_page_id",), _missing("menu_page_id")
    ),
    IntegrityRule(
        "IC-8", "menu_item", "price must be null or nonzero", ("price",), lambda df: F.col("price") == 0
    ),
    IntegrityRule(
        "IC-9", "menu_item", "high_price must be null or >= 0", ("high_price",), lambda df: F.col("high_price") < 0
    ),
    IntegrityRule("IC-10", "menu_item", "MenuItem.dish_id is required", ("dish_id",), _missing("dish_id")),
    IntegrityRule(
        "IC-11",
        "menu_item",
        "high_price = 0 requires a non-null price",
        ("price", "high_price"),
        lambda df: (F.col("high_price") == 0) & F.col("price").isNull(),
    ),
    IntegrityRule("IC-12", "menu_page", "MenuPage.id is required", (), _missing("id")),
    IntegrityRule("IC-13", "menu_page", "MenuPage.menu_id is required", ("menu_id",), _missing("menu_id")),
    IntegrityRule("IC-14", "dish", "Dish.id is required", (), _missing("id")),
    IntegrityRule(
        "IC-15",
        "dish",
        "lowest_price must be between 0 and 1100",
        ("lowest_price",),
        _price_band("lowest_price", V.CHECK_MAX_LOWEST),
    ),
    IntegrityRule(
        "IC-16",
        "dish",
        "highest_price must be between 0 and 3100",
        ("highest_price",),
        _price_band("highest_price", V.CHECK_MAX_HIGHEST),
    ),
    IntegrityRule(
        "IC-17",
        "dish",
        "highest_price must be >= lowest_price",
        ("lowest_price", "highest_price"),
        lambda df: F.col("highest_price") < F.col("lowest_price"),
    ),
)


# --- inclusion --------------------------------------------------------------
def ind_violations(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str = "id", nulls: str = "violate"
) -> DataFrame:
    """Child rows whose key is absent from the parent; a NULL key counts unless ``ignore``."""
    if nulls == "ignore":
        child = child.where(F.col(key).isNotNull())
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return child.join(keys, F.col(key) == F.col("_parent"), "left_anti")


def ind_kept(child: DataFrame, key: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Child rows whose key exists in the parent."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return child.join(keys, F.col(key) == F.col("_parent"), "left_semi")


def tag_ind(rows: DataFrame, rule_id: str, table: str) -> DataFrame:
    return rows.select(F.lit(rule_id).alias("IND_reason"), F.lit(table).alias("source_table"), "*")


# --- functional dependencies ------------------------------------------------
def distinct_with_null(column: str) -> Column:
    """Distinct values with NULL counted as a value."""
    has_null = (F.count(F.lit(1)) > F.count(column)).cast("bigint")
    return F.count_distinct(column) + has_null


def fd_violations(
    df: DataFrame, rule_id: str, keys: list[str], attributes: dict[str, str]
) -> DataFrame:
    """Keys on several rows: ``fd_violation`` if an attribute differs, else ``duplicate_load``.

    ``attributes`` maps each dependent column to the name of its count.  Repeated keys are
    found first from the key columns alone; only their rows are shuffled with attributes
    for the distinct counts.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    rows = join_groups(df.select(*keys, *attributes), repeated, keys, "_rows", "left_semi")
    counts = [distinct_with_null(c).alias(n) for c, n in attributes.items()]
    most = F.greatest(*attributes.values()) if len(attributes) > 1 else F.col(*attributes.values())
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"), *counts)
        .select(
            F.lit(rule_id).alias("rule_id"),
            *keys,
            "row_count",
            *attributes.values(),
            F.when(most > 1, "fd_violation").otherwise("duplicate_load").alias("disposition"),
        )
    )


def fd_report(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """How many distinct values a key goes with: a report, not a violation."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"), distinct_with_null(counted).alias(name))
        .where(F.col(name) > 1)
    )


FD_KEYS = {
    "FD-1": (
        "menu",
        ["id"],
        {"currency": "currency_values", "year": "year_values", "month": "month_values", "day": "day_values"},
    ),
    "FD-2": ("menu_page", ["id"], {"menu_id": "menu_id_values"}),
    "FD-3": (
        "menu_item",
        ["id"],
        {
            "menu_page_id": "page_values",
            "price": "price_values",
            "high_price": "high_price_values",
            "dish_id": "dish_id_values",
        },
    ),
    "FD-5": (
        "dish",
        ["id"],
        {
            "name": "name_values",
            "lowest_price": "lowest_price_values",
            "highest_price": "highest_price_values",
        },
    ),
}


def _line_prices(items: DataFrame) -> DataFrame:
    """Lines per (page, dish, price); equal lines meet where they are read."""
    return (
        items.where(F.col("dish_id").isNotNull())
        .groupBy("menu_page_id", "dish_id", "price")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def price_conflicts(items: DataFrame) -> DataFrame:
    """FD-4: a dish listed twice on a page must be priced once or not at all.

    A group is described by its counts and its price range, whatever its size;
    :func:`conflict_prices` lists its prices.
    """
    return (
        _line_prices(items)
        .groupBy("menu_page_id", "dish_id")
        .agg(
            F.sum("n").alias("line_count"),
            F.count(F.lit(1)).alias("distinct_prices"),
            F.sum(F.when(F.col("price").isNotNull(), F.col("n")).otherwise(0)).alias("priced_lines"),
            F.count("price").alias("_real"),
            F.min("price").alias("low_price"),
            F.max("price").alias("high_price"),
        )
        .where("distinct_prices > 1")
        .select(
            F.lit("FD-4").alias("rule_id"),
            "menu_page_id",
            "dish_id",
            "line_count",
            "distinct_prices",
            "priced_lines",
            F.when(F.col("_real") > 1, "conflicting_prices")
            .otherwise("price_and_blank")
            .alias("disposition"),
            "low_price",
            "high_price",
        )
    )


def conflict_prices(items: DataFrame) -> DataFrame:
    """Every price of every FD-4 group with its number of lines, one row each."""
    lines = _line_prices(items)
    groups = lines.groupBy("menu_page_id", "dish_id").agg(F.count(F.lit(1)).alias("prices")).where("prices > 1")
    return join_groups(lines, groups, ["menu_page_id", "dish_id"], "prices", "left_semi")
