"""Fallback prices, menu averages, tiers and cap sensitivity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.operators.quantiles import exact_quantiles
from scrubline.operators.ranking import ranked, tile, top_rows
from scrubline.vocab import PriceSource, Reason

#: Decimals that means are rounded to, so that the order of summing rows changes no digit.
DIGITS = 9


def fallback_prices(items: DataFrame, dishes: DataFrame) -> DataFrame:
    """Add ``clean_price_candidate``, ``price_source`` and ``exclusion_reason`` to every item.

    Item price, item high price, mean of both dish prices, dish lowest, dish highest; a
    price counts if it is not NULL and above zero.  Items need not have a dish.
    """
    d = dishes.select(
        F.col("id").alias("_dish"),
        F.col("lowest_price").alias("dish_lowest_price"),
        F.col("highest_price").alias("dish_highest_price"),
    )
    joined = items.join(d, F.col("dish_id") == F.col("_dish"), "left").drop("_dish")
    low, high = F.col("dish_lowest_price"), F.col("dish_highest_price")

    def first_valid(chain: list[tuple[Column, Column, str]]) -> tuple[Column, Column]:
        price, source = F.lit(None).cast("double"), F.lit(PriceSource.NONE)
        for ok, value, name in reversed(chain):
            price = F.when(ok, value).otherwise(price)
            source = F.when(ok, F.lit(name)).otherwise(source)
        return price, source

    price, source = first_valid(
        [
            (F.col("price") > 0, F.col("price"), PriceSource.ITEM_PRICE),
            (F.col("high_price") > 0, F.col("high_price"), PriceSource.ITEM_HIGH_PRICE),
            ((low > 0) & (high > 0), (low + high) / 2, PriceSource.DISH_AVERAGE),
            (low > 0, low, PriceSource.DISH_LOWEST),
            (high > 0, high, PriceSource.DISH_HIGHEST),
        ]
    )
    no_price = F.col("price_source") == PriceSource.NONE
    return joined.withColumns({"clean_price_candidate": price, "price_source": source}).withColumn(
        "exclusion_reason", F.when(no_price, Reason.NO_VALID_FALLBACK_PRICE)
    )


def price_source_counts(priced: DataFrame) -> DataFrame:
    """One row per source (zero included): items, and the share of usable items recovered by fallback."""
    counts = priced.agg(
        *(F.count_if(F.col("price_source") == s).alias(s) for s in PriceSource.ALL)
    )
    usable = sum((F.col(s) for s in PriceSource.ALL[:-1]), F.lit(0))
    lines = [
        F.struct(
            F.lit(i + 1).alias("priority"),
            F.lit(s).alias("price_source"),
            F.col(s).alias("items"),
            F.lit(s not in (PriceSource.ITEM_PRICE, PriceSource.NONE)).alias("recovered"),
            (
                F.when(F.lit(s != PriceSource.NONE) & (usable > 0), F.col(s) * 100.0 / usable)
            ).alias("pct_of_usable"),
        )
        for i, s in enumerate(PriceSource.ALL)
    ]
    return counts.select(F.inline(F.array(*lines)))


def mean_price(price: Column) -> Column:
    """Mean in double precision, rounded to nine decimals; any price counts, however large."""
    return F.round(F.avg(price), DIGITS)


def year_period(year: Column) -> Column:
    return year


def decade_period(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def menu_averages(
    final_menu: DataFrame,
    final_item: DataFrame,
    min_items: int = 1,
    period: Callable[[Column], Column] = decade_period,
) -> DataFrame:
    """Item count and mean price per menu with its period; only positive prices count.

    Items are averaged before the join, so the join sees one row per menu.
    """
    per_menu = (
        final_item.where(F.col("clean_item_price") > 0)
        .groupBy("menu_id")
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            mean_price(F.col("clean_item_price")).alias("avg_price"),
        )
        .where(F.col("item_count") >= min_items)
    )
    return per_menu.join(
        final_menu.select("menu_id", period(F.col("cleaned_year")).alias("period")), "menu_id"
    ).select("menu_id", "period", "item_count", "avg_price")


def price_tiers(averages: DataFrame) -> DataFrame:
    """Quarter of the period's menus each one falls in, with its ``$`` to ``$$$$`` label."""
    order = [F.col("avg_price"), F.col("menu_id")]
    tiers = ranked(averages, "period", order).withColumn("tier", tile(4))
    return tiers.select(
        "menu_id", "period", "item_count", "avg_price", "tier", F.repeat(F.lit("$"), F.col("tier")).alias("label")
    )


def top_menus(averages: DataFrame, k: int = 5) -> DataFrame:
    """The most and the least expensive menus of each period."""
    most = top_rows(averages, ["period"], [F.desc("avg_price"), F.asc("menu_id")], k)
    least = top_rows(averages, ["period"], [F.asc("avg_price"), F.asc("menu_id")], k)
    return most.select(F.lit("most_expensive").alias("end"), "*").unionByName(
        least.select(F.lit("least_expensive").alias("end"), "*")
    )


def cap_sensitivity(
    items: DataFrame, pages: DataFrame, menus: DataFrame, limits: tuple[float, ...] = V.CAP_LIMITS
) -> DataFrame:
    """Effect of candidate cap limits on the mean item price of menus, by price quarter.

    Thresholds come from all positive item prices; menus are those in scope, quartered by
    their uncapped mean.  All limits are measured in one pass over the joined items.
    """
    caps = exact_quantiles(items, {"price": F.col("price")}, [1 - x for x in limits]).agg(
        F.struct(
            *(
                F.max(F.when(F.abs(F.col("prob") - (1 - x)) < 1e-9, F.col("value"))).alias(f"cap{i}")
                for i, x in enumerate(limits)
            )
        ).alias("caps")
    ).scalar()
    price = F.col("price")
    on_menu = (
        items.where(price > 0)
        .select("menu_page_id", "price", caps.alias("caps"))
        .join(pages.select(F.col("id").alias("menu_page_id"), "menu_id"), "menu_page_id")
    )
    capped = [F.least(price, F.col(f"caps.cap{i}")) for i in range(len(limits))]
    per_menu = (
        on_menu.groupBy("menu_id")
        .agg(
            mean_price(price).alias("avg_price"),
            *(mean_price(c).alias(f"avg{i}") for i, c in enumerate(capped)),
            *(F.count_if(price > F.col(f"caps.cap{i}")).alias(f"hit{i}") for i in range(len(limits))),
            *(F.max(f"caps.cap{i}").alias(f"cap{i}") for i in range(len(limits))),
        )
        .join(menus.select(F.col("id").alias("menu_id")), "menu_id", "left_semi")
        .withColumn("scope", F.lit(1))
    )
    quartered = ranked(per_menu, "scope", [F.col("avg_price"), F.col("menu_id")]).withColumn(
        "quarter", tile(4)
    )
    total = F.sum("avg_price").alias("before")
    sums = [F.sum(f"avg{i}").alias(f"after{i}") for i in range(len(limits))]
    hits = [F.sum(f"hit{i}").alias(f"hits{i}") for i in range(len(limits))]
    edges = [F.max(f"cap{i}").alias(f"edge{i}") for i in range(len(limits))]
    by_quarter = quartered.groupBy("quarter").agg(F.count(F.lit(1)).alias("menus"), total, *sums, *hits, *edges)
    lines = [
        F.struct(
            F.lit(x * 100).alias("limit_pct"),
            F.col(f"edge{i}").alias("threshold"),
            F.col("quarter"),
            F.col("menus"),
            F.col(f"hits{i}").alias("items_capped"),
            F.round((F.col(f"after{i}") - F.col("before")) * 100 / F.col("before"), DIGITS).alias("pct_change"),
        )
        for i, x in enumerate(limits)
    ]
    return by_quarter.select(F.inline(F.array(*lines)))


def longest_running(df: DataFrame, key: str, seen: str, k: int) -> DataFrame:
    """The ``k`` keys with the longest time between first and last appearance."""
    days = F.date_diff(F.col("last_seen"), F.col("first_seen"))
    return (
        df.groupBy(key)
        .agg(F.min(seen).cast("date").alias("first_seen"), F.max(seen).cast("date").alias("last_seen"))
        .withColumn("span_days", days)
        .orderBy(F.desc("span_days"), F.asc(key))
        .limit(k)
    )


def items_of_menus(
    items: DataFrame, pages: DataFrame, dishes: DataFrame, menu_id: str | None = None
) -> DataFrame:
    """Transcribed dish names on each menu, or on one of them, as recorded (no cleaning)."""
    if menu_id is not None:
        pages = pages.where(F.col("menu_id") == menu_id)
    bridge = pages.select(F.col("id").alias("menu_page_id"), "menu_id")
    names = dishes.select(F.col("id").alias("dish_id"), "name")
    return (
        items.select(F.col("id").alias("menu_item_id"), "menu_page_id", "dish_id", "price")
        .join(bridge, "menu_page_id")
        .join(names, "dish_id", "left")
        .select("menu_id", "menu_page_id", "menu_item_id", "dish_id", "name", "price")
    )
