"""All rules over a set of staged tables, uniform violations, before and after repair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.operators.checks import (
    FD_KEYS,
    INTEGRITY_RULES,
    fd_violations,
    ind_violations,
    price_conflicts,
    stored_type,
)
from scrubline.plans.staging import Tables, final_item, final_menu

UNIFORM = (
    "iteration",
    "family",
    "rule_id",
    "source_table",
    "row_key",
    "disposition",
    "violation",
    "details",
)
FD_STATEMENTS = {
    "FD-1": "id -> currency, year, month, day",
    "FD-2": "id -> menu_id",
    "FD-3": "id -> menu_page_id, price, high_price, dish_id",
    "FD-4": "menu_page_id, dish_id -> price",
    "FD-5": "id -> name, lowest_price, highest_price",
}
FD4_KEYS = ("menu_item", ["menu_page_id", "dish_id"])
IND_RULES = (
    ("IND-1", "menu_page", "menu_id", "menu"),
    ("IND-2", "menu_item", "menu_page_id", "menu_page"),
    ("IND-3", "menu_item", "dish_id", "dish"),
)


def _details(columns: list[str]) -> Column:
    cells = (F.col(c).cast("string").alias(c) for c in columns)
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def _uniform(
    rows: DataFrame, iteration: int, family: str, rule: str, table: str, key: Column, disposition: Column, text: str
) -> DataFrame:
    return rows.select(
        F.lit(iteration).alias("iteration"),
        F.lit(family).alias("family"),
        F.lit(rule).alias("rule_id"),
        F.lit(table).alias("source_table"),
        key.cast("string").alias("row_key"),
        disposition.alias("disposition"),
        F.lit(text).alias("violation"),
        _details([c for c in rows.columns if c not in ("rule_id", "violation", "disposition")]),
    ).toDF(*UNIFORM)


def _fd_rows(rule: str, rows: DataFrame) -> DataFrame:
    """Violations of one dependency in the rows of its table."""
    if rule == "FD-4":
        return price_conflicts(rows)
    _, keys, attributes = FD_KEYS[rule]
    return fd_violations(rows, rule, keys, attributes)


def fd_results(tables: Tables) -> Tables:
    found = {rule: _fd_rows(rule, tables[table]) for rule, (table, _, _) in FD_KEYS.items()}
    found["FD-4"] = _fd_rows("FD-4", tables[FD4_KEYS[0]])
    return dict(sorted(found.items()))


def integrity_rows(df: DataFrame, table: str, iteration: int) -> DataFrame:
    """Violations of all integrity rules of a table from one scan of it."""
    rules = [r for r in INTEGRITY_RULES if r.table == table]
    found, any_hit = [], F.lit(False)
    for rule in rules:
        hit = F.coalesce(rule.predicate(df), F.lit(False))
        any_hit |= hit
        shown = [F.col(c).cast("string").alias(c) for c in ("id", *rule.columns)]
        if rule.typed:
            shown.append(stored_type(df, rule.columns[0]).alias("stored_type"))
        details = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"})
        cell = F.struct(
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.violation).alias("violation"),
            details.alias("details"),
        )
        found.append(F.when(hit, cell))
    return (
        df.where(any_hit)
        .select(F.col("id").cast("string").alias("row_key"), F.explode(F.array(*found)).alias("hit"))
        .where(F.col("hit").isNotNull())
        .select(
            F.lit(iteration).alias("iteration"),
            F.lit("IC").alias("family"),
            "hit.rule_id",
            F.lit(table).alias("source_table"),
            "row_key",
            F.lit(None).cast("string").alias("disposition"),
            "hit.violation",
            "hit.details",
        )
    )


def violations(tables: Tables, iteration: int = 0) -> DataFrame:
    """Every violating row of every rule in one schema."""
    none = F.lit(None).cast("string")
    parts = [integrity_rows(tables[t], t, iteration) for t in ("menu", "menu_page", "menu_item", "dish")]
    for rule, child, key, parent in IND_RULES:
        rows = ind_violations(tables[child], key, tables[parent]).select("id", key)
        text = f"{child}.{key} must exist in {parent}.id"
        parts.append(_uniform(rows, iteration, "IND", rule, child, F.col("id"), none, text))
    for rule, rows in fd_results(tables).items():
        table = "menu_item" if rule == "FD-4" else FD_KEYS[rule][0]
        pair = F.concat_ws("|", F.col("menu_page_id").cast("string"), F.col("dish_id").cast("string"))
        key = pair if rule == "FD-4" else F.col("id")
        parts.append(
            _uniform(
                rows, iteration, "FD", rule, table, key, F.col("disposition"), FD_STATEMENTS[rule]
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _integrity_counts(df: DataFrame, table: str) -> DataFrame:
    rules = [r for r in INTEGRITY_RULES if r.table == table]
    row = df.agg(*(F.count_if(r.predicate(df)).alias(r.rule_id) for r in rules))
    lines = [
        F.struct(
            F.lit("IC").alias("family"),
            F.lit(r.rule_id).alias("rule_id"),
            F.col(f"`{r.rule_id}`").alias("violations"),
        )
        for r in rules
    ]
    return row.select(F.inline(F.array(*lines)))


def rule_counts(tables: Tables, iteration: int = 0) -> DataFrame:
    """Violating rows per rule, zero included.

    Integrity rules of a table are counted in one scan of it.
    """
    parts = [_integrity_counts(tables[t], t) for t in ("menu", "menu_page", "menu_item", "dish")]
    found = {r: ind_violations(tables[c], k, tables[p]) for r, c, k, p in IND_RULES}
    found.update(fd_results(tables))
    for rule, rows in found.items():
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(rule.split("-")[0]).alias("family"), F.lit(rule).alias("rule_id"), "violations"
            )
        )
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(iteration).alias("iteration"), "family", "rule_id", "violations"
    )


def touching(rows: DataFrame, touched: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows whose keys are among the touched ones, or are not (``left_anti``); NULL equals NULL."""
    named = touched.select(*(F.col(k).alias(f"_touched_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_touched_{k}")) for k in keys))
    return rows.join(named, same, how)


def recount(
    counts: DataFrame, before: Tables, after: Tables, gone: Tables, come: Tables, iteration: int
) -> DataFrame:
    """Counts of ``iteration`` from those before it and the rows that went and came.

    ``gone`` and ``come`` hold, for each changed table, its rows as they were and as they are.  A
    row rule is counted over these rows alone.  An inclusion rule looks at them, and at the
    children of changed parents; a dependency rule at the rows, before and after, whose keys they
    hold.  Rules of tables that haven't changed keep their counts.
    """
    deltas = [counts.select("family", "rule_id", "violations")]

    def add(rule: str, rows: DataFrame, sign: int) -> None:
        n = rows.agg((F.count(F.lit(1)) * sign).alias("violations"))
        deltas.append(n.select(F.lit(rule.split("-")[0]).alias("family"), F.lit(rule).alias("rule_id"), "violations"))

    for table in gone:
        for rows, sign in ((gone[table], -1), (come[table], 1)):
            found = _integrity_counts(rows, table)
            deltas.append(found.withColumn("violations", F.col("violations") * sign))
    for rule, child, key, parent in IND_RULES:
        if parent in gone:
            moved = gone[parent].select("id").union(come[parent].select("id")).withColumnRenamed("id", key)
            if child in gone:
                moved = moved.union(gone[child].select(key)).union(come[child].select(key))
            for tables, sign in ((before, -1), (after, 1)):
                rows = touching(tables[child], moved.distinct(), [key])
                add(rule, ind_violations(rows, key, tables[parent]), sign)
        elif child in gone:
            add(rule, ind_violations(gone[child], key, before[parent]), -1)
            add(rule, ind_violations(come[child], key, after[parent]), 1)
    for rule, (table, keys) in {**{r: (t, k) for r, (t, k, _) in FD_KEYS.items()}, "FD-4": FD4_KEYS}.items():
        if table in gone:
            moved = gone[table].select(*keys).union(come[table].select(*keys)).distinct()
            for tables, sign in ((before, -1), (after, 1)):
                add(rule, _fd_rows(rule, touching(tables[table], moved, keys)), sign)
    return (
        reduce(DataFrame.unionByName, deltas)
        .groupBy("family", "rule_id")
        .agg(F.sum("violations").alias("violations"))
        .select(F.lit(iteration).alias("iteration"), "family", "rule_id", "violations")
    )


def violation_delta(counts: DataFrame) -> DataFrame:
    """Before, after and resolved per rule, from the counts of the first and the last iteration."""
    last = counts.agg(F.max("iteration")).scalar()
    at = {
        name: F.sum(F.when(F.col("iteration") == i, F.col("violations")).otherwise(0)).alias(name)
        for i, name in ((F.lit(0), "before_repair"), (last, "after_repair"))
    }
    return (
        counts.groupBy("family", "rule_id")
        .agg(*at.values())
        .withColumn("resolved", F.col("before_repair") - F.col("after_repair"))
    )


def validation_report(counts: DataFrame) -> DataFrame:
    """Every rule with its statement, its violations at the start and the end, and the outcome:
    ``holds``, ``resolved``, ``reduced`` or ``accepted``."""
    rules = [(r.rule_id, r.table, r.violation) for r in INTEGRITY_RULES]
    rules += [(r, c, f"{c}.{k} must exist in {p}.id") for r, c, k, p in IND_RULES]
    rules += [(r, "menu_item" if r == "FD-4" else FD_KEYS[r][0], text) for r, text in FD_STATEMENTS.items()]
    stated = F.inline(
        F.array(*(F.struct(F.lit(r).alias("rule_id"), F.lit(t).alias("source_table"), F.lit(s).alias("statement")) for r, t, s in rules))
    )
    statements = counts.sparkSession.range(1).select(stated)
    before, after = F.col("before_repair"), F.col("after_repair")
    outcome = F.when(before + after == 0, "holds").when(after == 0, "resolved").when(after < before, "reduced").otherwise("accepted")
    return violation_delta(counts).join(statements, "rule_id").select(
        "family", "rule_id", "source_table", "statement", "before_repair", "after_repair", "resolved", outcome.alias("outcome")
    )


def eligible_items(tables: Tables) -> DataFrame:
    """Items that can enter a menu average: on a page and a dish, with a positive price."""
    return final_item(tables).where(F.col("clean_item_price") > 0)


def iteration_metrics(counts: DataFrame, passes: dict[int, Tables]) -> DataFrame:
    """Per pass: violations by family, item rows, and eligible menus and items."""
    totals = counts.groupBy("iteration").agg(
        *(
            F.sum(F.when(F.col("family") == f, F.col("violations")).otherwise(0)).alias(f"{f.lower()}_violations")
            for f in ("IC", "IND", "FD")
        )
    )
    sizes = []
    for i, tables in passes.items():
        menus = final_menu(tables).select("menu_id")
        on_menu = eligible_items(tables).join(menus, "menu_id", "left_semi")
        sizes.append(
            on_menu.agg(
                F.count(F.lit(1)).alias("eligible_items"),
                F.count_distinct("menu_id").alias("eligible_menus"),
            ).select(
                F.lit(i).alias("iteration"),
                tables["menu_item"].agg(F.count(F.lit(1)).alias("n")).scalar().alias("item_rows"),
                "eligible_items",
                "eligible_menus",
            )
        )
    # One row per pass on both sides.
    return totals.join(reduce(DataFrame.unionByName, sizes), "iteration")
