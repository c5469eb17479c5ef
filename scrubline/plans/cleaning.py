"""The cleaning chain of each table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.functions.cleaners import CURRENCY, DATE, DECIMAL, INT, NAME
from scrubline.functions.unicode import has_text
from scrubline.operators.stages import (
    Apply,
    Drop,
    Expand,
    Lookup,
    Note,
    Stage,
    TagRows,
    Trace,
    Winsorize,
    run_stages,
)
from scrubline.vocab import Op, Reason


def number(text: Column) -> Column:
    """Lenient numeric reading: NULL where it does not parse."""
    return text.try_cast("double")


def is_positive(text: Column) -> Column:
    return F.coalesce(number(text) > 0, F.lit(False))


def _null(column: str):
    return lambda c: c(column).isNull()


def _ids(*columns: str, optional: tuple[str, ...] = ()) -> Stage:
    notes = [Note(c, Reason.MALFORMED_ID, _null(c)) for c in columns]
    notes += [Note(c, Reason.MISSING_REQUIRED_ID, _null(c), always=True) for c in optional]
    return Stage("id-numeric", tuple(Apply(c, INT) for c in columns + optional), tuple(notes))


def _prices(*columns: str, always_missing: bool = False) -> Stage:
    notes = []
    for name in columns:
        notes.append(Note(name, Reason.MISSING_PRICE, _null(name), always=always_missing))
        notes.append(Note(name, Reason.NON_POSITIVE_PRICE, lambda c, n=name: number(c(n)) <= 0))
    steps = tuple(Apply(c, DECIMAL, record_changes=False) for c in columns)
    return Stage("price-decimal", steps, tuple(notes))


def no_price_signal(c: Lookup) -> Column:
    """No dish to fall back on and no positive price of its own."""
    return c("dish_id").isNull() & ~is_positive(c("price")) & ~is_positive(c("high_price"))


def unmapped_currency(c: Lookup) -> Column:
    return c("currency").isNotNull() & ~c("currency").isin(*V.CURRENCY_MAP.values())


CHAINS: dict[str, tuple[Stage, ...]] = {
    "menu": (
        _ids("id"),
        Stage(
            "date-split",
            (Expand("date", DATE, ("year", "month", "day")), Drop("date")),
            (Note("date", Reason.INVALID_DATE, _null("year")),),
        ),
        Stage(
            "currency-map",
            (Apply("currency", CURRENCY),),
            (Note("currency", Reason.AMBIGUOUS_CURRENCY, unmapped_currency),),
        ),
        Stage("drop-status", (Drop("status", only_constant=True),)),
    ),
    "menu_page": (_ids("id", "menu_id"),),
    "dish": (
        _ids("id"),
        Stage("dish-name", (Apply("name", NAME, trivial_ops=(Op.UPPERCASED,)),)),
        _prices("lowest_price", "highest_price"),
        Stage("price-outlier", (Winsorize(V.WINSORIZE_COLUMNS["dish"]),)),
    ),
    "menu_item": (
        _ids("id", "menu_page_id", optional=("dish_id",)),
        _prices("price", "high_price", always_missing=True),
        Stage("price-outlier", (Winsorize(V.WINSORIZE_COLUMNS["menu_item"]),)),
        Stage("omit-check", (TagRows(V.OMIT, Reason.NO_DISH_ID_AND_NO_PRICE, no_price_signal),)),
    ),
}


def clean_table(table: str, stamped: DataFrame) -> Trace:
    """Run a table's chain over a stamped text frame."""
    return run_stages(table, stamped, CHAINS[table])


def scope_menu(menu: DataFrame) -> DataFrame:
    """Complete, dated, dollar menus of a plausible year."""
    return menu.where(scope_predicates()[-1][1])


def scope_predicates() -> list[tuple[str, Column]]:
    """The scope filters in order, each including the ones before it."""
    year = F.substring("date", 1, 4).try_cast("int")
    single = [
        ("currency", F.col("currency") == "Dollars"),
        ("status", F.col("status") == "complete"),
        ("date", has_text(F.col("date"))),
        ("year", year.between(V.MIN_PLAUSIBLE_YEAR, V.MAX_PLAUSIBLE_YEAR)),
    ]
    steps, so_far = [("raw", F.lit(True))], F.lit(True)
    for name, predicate in single:
        so_far = so_far & F.coalesce(predicate, F.lit(False))
        steps.append((name, so_far))
    return steps


def scope_waterfall(menu: DataFrame) -> DataFrame:
    """Rows left and removed after each scope filter, in one aggregate."""
    steps = scope_predicates()
    row = menu.agg(*(F.count_if(p).alias(n) for n, p in steps))
    lines = []
    for i, (name, _) in enumerate(steps):
        removed = F.col(steps[i - 1][0]) - F.col(name) if i else F.lit(0).cast("bigint")
        lines.append(
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("filter"),
                F.col(name).alias("remaining"),
                removed.alias("removed"),
            )
        )
    return row.select(F.inline(F.array(*lines)))


def scope_dish(dish: DataFrame) -> DataFrame:
    """Dishes with at least one price cell filled in."""
    return dish.where(has_price_cell())


def has_price_cell() -> Column:
    return has_text(F.col("lowest_price")) | has_text(F.col("highest_price"))
