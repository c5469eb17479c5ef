"""Typed staging tables, the load cascade with its inclusion checks, and the final tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.operators.checks import ind_kept, ind_violations, tag_ind

STAGED = {
    "menu": ("id bigint", "currency string", "year int", "month int", "day int"),
    "menu_page": ("id bigint", "menu_id bigint"),
    "menu_item": ("id bigint", "menu_page_id bigint", "price double", "high_price double", "dish_id bigint"),
    "dish": ("id bigint", "name string", "lowest_price double", "highest_price double"),
}

Tables = dict[str, DataFrame]


def typed(table: str, cleaned: DataFrame) -> DataFrame:
    """Cleaned columns in their staging order and types."""
    pairs = [c.split() for c in STAGED[table]]
    return cleaned.select(*(F.col(n).cast(t).alias(n) for n, t in pairs))


def traced(table: str, rows: DataFrame) -> DataFrame:
    """Staging columns and types, with the source file and row that each row came from."""
    pairs = [c.split() for c in STAGED[table]]
    return rows.select(*(F.col(n).cast(t).alias(n) for n, t in pairs), V.SOURCE_FILE, V.SOURCE_ROW)


def load(tables: Tables) -> Tables:
    """Keep the rows whose parents survived: pages by menu, items by page, then by dish."""
    pages = ind_kept(tables["menu_page"], "menu_id", tables["menu"])
    items = ind_kept(ind_kept(tables["menu_item"], "menu_page_id", pages), "dish_id", tables["dish"])
    return {**tables, "menu_page": pages, "menu_item": items}


def ind_results(tables: Tables, nulls: str = "violate") -> Tables:
    """Violations of the three load-time inclusion rules, each against surviving parents."""
    pages = ind_kept(tables["menu_page"], "menu_id", tables["menu"])
    on_page = ind_kept(tables["menu_item"], "menu_page_id", pages)
    return {
        "IND-1": ind_violations(tables["menu_page"], "menu_id", tables["menu"], nulls=nulls),
        "IND-2": ind_violations(tables["menu_item"], "menu_page_id", pages, nulls=nulls),
        "IND-3": ind_violations(on_page, "dish_id", tables["dish"], nulls=nulls),
    }


def ind_report(tables: Tables) -> DataFrame:
    """All inclusion violations in one frame; columns a rule lacks are NULL."""
    found = ind_results(tables)
    out = tag_ind(found["IND-1"], "IND-1", "stg_menu_page")
    for rule in ("IND-2", "IND-3"):
        out = out.unionByName(tag_ind(found[rule], rule, "stg_menu_item"), allowMissingColumns=True)
    return out


def final_menu(tables: Tables) -> DataFrame:
    return tables["menu"].select(
        F.col("id").alias("menu_id"),
        F.col("year").alias("cleaned_year"),
        F.col("currency").alias("currency_clean"),
    )


def final_item(tables: Tables) -> DataFrame:
    """Items with their menu and dish name; rows without a page or a dish drop out."""
    pages = tables["menu_page"].select(F.col("id").alias("menu_page_id"), "menu_id")
    dishes = tables["dish"].select(F.col("id").alias("dish_id"), F.col("name").alias("dish_name"))
    return (
        tables["menu_item"]
        .select(F.col("id").alias("menu_item_id"), "menu_page_id", "dish_id", "price")
        .join(pages, "menu_page_id")
        .join(dishes, "dish_id")
        .select("menu_item_id", "menu_id", "dish_name", F.col("price").alias("clean_item_price"))
    )


def final_item_priced(priced: DataFrame, pages: DataFrame) -> DataFrame:
    """The declared final item: fallback price, its source and the prices it came from.

    ``priced`` comes from :func:`scrubline.operators.pricing.fallback_prices`; only items
    with a positive price and a page stay.
    """
    bridge = pages.select(F.col("id").alias("menu_page_id"), "menu_id")
    return (
        priced.where(F.col("clean_price_candidate") > 0)
        .join(bridge, "menu_page_id")
        .select(
            F.col("id").alias("menu_item_id"),
            "menu_id",
            "menu_page_id",
            "dish_id",
            F.col("clean_price_candidate").alias("clean_item_price"),
            "price_source",
            F.col("price").alias("original_price"),
            F.col("high_price").alias("original_high_price"),
            "dish_lowest_price",
            "dish_highest_price",
        )
    )


def as_money(df: DataFrame, *columns: str) -> DataFrame:
    """Prices as ``decimal(18,2)`` for a final sink, without rows that have one too large for it.

    :func:`too_large` gives those rows, which belong to the excluded records.
    """
    return fitting(df, *columns).withColumns({c: F.col(c).try_cast("decimal(18,2)") for c in columns})


def fitting(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(~_unfit(columns))


def too_large(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(_unfit(columns))


def _unfit(columns: tuple[str, ...]) -> Column:
    return reduce(or_, (F.col(c).isNotNull() & F.col(c).try_cast("decimal(18,2)").isNull() for c in columns))
