"""Named queries over the derived menu tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from scrubline import vocab as V
from scrubline.functions import CURRENCY, DATE, DECIMAL, INT, NAME, TEXT, Cleaner, keys
from scrubline.functions.unicode import fold_accents
from scrubline.operators import accounting, checks, clusters, pricing, profile, quantiles, repair, sketches
from scrubline.operators.stages import Apply, Stage, Trace, run_stages
from scrubline.operators.status import row_status
from scrubline.plans import cleaning, passes, staging, validation
from scrubline.plans.staging import Tables
from scrubline.sources import fixtures
from scrubline.sources.text import stamp_rows
from scrubline.sources.workspace import Workspace, content_version

Query = Callable[[SparkSession, str], DataFrame]
TABLES = ("menu", "menu_page", "menu_item", "dish")
SEP = V.LOG_SEPARATOR
#: Columns with about as many values as their table has rows.
KEYS = ("id", "menu_id", "menu_page_id", V.SOURCE_ROW)


class Menus:
    """The four tables of one input folder through every phase, each phase written once."""

    _open: dict[tuple[str, str], Menus] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Menus:
        key = (spark.sparkContext.applicationId, sf_dir)
        version = content_version(spark, sf_dir)
        if key not in cls._open or cls._open[key].version != version:
            cls._open[key] = cls(spark, sf_dir)
            cls._open[key].version = version
        return cls._open[key]

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.work = Workspace(spark)
        self._traces: dict[tuple[str, bool], Trace] = {}
        self._passes: list[passes.Pass] = []

    def base(self, table: str) -> DataFrame:
        return fixtures.base(self.spark, self.sf_dir, table)

    def raw(self, table: str) -> DataFrame:
        return fixtures.raw_table(self.spark, self.sf_dir, table)

    def export(self, table: str) -> DataFrame:
        """The raw table after scoping: what the cleaning chain is meant to read."""
        scope = {"menu": cleaning.scope_menu, "dish": cleaning.scope_dish}.get(table)
        return scope(self.raw(table)) if scope else self.raw(table)

    def trace(self, table: str, scoped: bool = False) -> Trace:
        """The table's cleaning chain over its raw rows or its scoped export."""
        scoped = scoped and table in ("menu", "dish")
        if (table, scoped) not in self._traces:
            source = self.export(table) if scoped else self.raw(table)
            made = cleaning.clean_table(table, fixtures.stamped(source, table))
            name = f"trace_{table}_{'export' if scoped else 'raw'}"
            keys = tuple(c for c in made.df.columns if c.removesuffix("__0_value") in KEYS)
            self._traces[table, scoped] = replace(made, df=self.work.table(name, lambda: made.df, keys))
        return self._traces[table, scoped]

    def traces(self, scoped: bool = False) -> list[Trace]:
        """All tables' chains, cleaned side by side: no core waits for the last task of one table."""
        made = inheritable_thread_target(self.spark)(lambda table: self.trace(table, scoped))
        with ThreadPoolExecutor(len(TABLES)) as pool:
            return list(pool.map(made, TABLES))

    def changes(self) -> DataFrame:
        """Every changed cell, found once: a sort by ranges reads its input twice."""
        return self.work.table("changes", lambda: union([t.changes() for t in self.traces()]))

    def staged_table(self, table: str, scoped: bool = True) -> DataFrame:
        """One typed table before the load; the others aren't cleaned for it."""
        return staging.typed(table, self.trace(table, scoped).cleaned())

    def staged(self, scoped: bool = True) -> Tables:
        """Typed tables before the load."""
        return {t: self.staged_table(t, scoped) for t in TABLES}

    def staged_rows(self) -> Tables:
        """Typed tables before the load, with provenance."""
        return {t: staging.traced(t, self.trace(t, True).snapshot(rows="kept")) for t in TABLES}

    def loaded_rows(self) -> Tables:
        return {t: self.work.table(f"loaded_{t}", lambda t=t: staging.load(self.staged_rows())[t]) for t in TABLES}

    def loaded(self) -> Tables:
        return passes.data(self.loaded_rows())

    def passes(self) -> list[passes.Pass]:
        """Checks and repairs of the loaded tables until nothing changes."""
        if not self._passes:
            self._passes = passes.repair_passes(self.loaded_rows(), lambda df, name: self.work.table(name, lambda: df))
        return self._passes

    def repaired(self) -> Tables:
        return passes.data(self.passes()[-1].tables)

    def rule_counts(self) -> DataFrame:
        return passes.all_counts(self.passes())

    def excluded(self) -> DataFrame:
        """Every source row that is in none of the final tables, with the rule that removed it."""
        return self.work.table("excluded_records", lambda: union([*self._excluded_before(), *self._excluded_after()]))

    def _excluded_before(self) -> list[DataFrame]:
        menus, dishes = (fixtures.stamped(self.raw(t), t) for t in ("menu", "dish"))
        scope = cleaning.scope_predicates()
        failed = F.concat(F.lit("scope:"), F.coalesce(*(F.when(~p, n) for n, p in scope[1:])))
        found = [
            accounting.excluded(menus.where(~scope[-1][1]), "menu", failed),
            accounting.excluded(dishes.where(~cleaning.has_price_cell()), "dish", "scope:price"),
            accounting.excluded(
                self.trace("menu_item").snapshot(rows="omitted"), "menu_item", V.Reason.NO_DISH_ID_AND_NO_PRICE
            ),
        ]
        for rule, rows in staging.ind_results(self.staged_rows()).items():
            found.append(accounting.excluded(rows, "menu_page" if rule == "IND-1" else "menu_item", rule))
        return found

    def _excluded_after(self) -> list[DataFrame]:
        last = self.passes()[-1]
        large = staging.too_large(last.tables["menu_item"], "price")
        return [*passes.excluded_in(self.passes()), accounting.excluded(large, "menu_item", V.Reason.PRICE_TOO_LARGE, last.number)]

    def kept(self) -> Tables:
        """The rows that the final tables are made of, with provenance."""
        tables = self.passes()[-1].tables
        return {**tables, "menu_item": staging.fitting(tables["menu_item"], "price")}

    def prepare(self) -> None:
        """Write every phase that queries share."""
        self.traces(), self.traces(scoped=True), self.passes()

    def priced(self) -> DataFrame:
        tables = self.staged()
        return pricing.fallback_prices(tables["menu_item"], tables["dish"])

    def averages(self, period: Callable[[Column], Column] = pricing.year_period) -> DataFrame:
        tables = self.repaired()
        return pricing.menu_averages(
            staging.final_menu(tables), staging.final_item(tables), period=period
        )

    def with_copies(self, table: str) -> DataFrame:
        """A staged table plus changed copies of keys ending in 0 and exact copies of keys ending in 1."""
        df = self.staged_table(table, False)
        shown = {"menu": "currency", "menu_page": "menu_id", "menu_item": "price", "dish": "name"}[table]
        kind = df.schema[shown].dataType.typeName()
        other = F.lit("changed") if kind == "string" else (F.col(shown) + 1).cast(kind)
        changed = df.where("id % 10 = 0").withColumn(shown, other)
        return df.unionByName(changed).unionByName(df.where("id % 10 = 1"))


QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Menus], DataFrame]], Callable[[Menus], DataFrame]]:
    def register(build: Callable[[Menus], DataFrame]) -> Callable[[Menus], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Menus.of(spark, sf_dir))
        return build

    return register


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- value cleaners ---------------------------------------------------------
def messy_numbers(orders: DataFrame) -> DataFrame:
    """Number texts of every accepted and rejected form, derived from order keys and totals."""
    return orders.selectExpr(
        "o_orderkey as id",
        """case o_orderkey % 9
             when 0 then concat(' ', cast(o_orderkey as string), ' ')
             when 1 then concat('$', cast(cast(o_totalprice as decimal(18,2)) as string))
             when 2 then concat(cast(o_orderkey % 1000 as string), ',000')
             when 3 then concat(cast(o_orderkey % 500 as string), '.125')
             when 4 then 'nan'
             when 5 then concat(cast(o_orderkey as string), 'd')
             when 6 then concat('-', cast(o_orderkey % 90 as string), '.5')
             when 7 then concat(cast(o_orderkey % 90 as string), 'e2')
             else '' end as raw""",
    )


def texts(m: Menus) -> DataFrame:
    """Every dish name and every document, whole."""
    dishes = m.raw("dish").select(F.lit("dish").alias("source"), "id", F.col("name").alias("raw"))
    documents = m.base("documents").select(
        F.lit("document").alias("source"), F.col("doc_id").cast("string").alias("id"), F.col("text").alias("raw")
    )
    return dishes.unionByName(documents)


def cleaned_cells(df: DataFrame, cleaner, *shown: str) -> DataFrame:
    done = cleaner.run(df, F.col("raw"), "c")
    return done.select(*shown, F.col("c_value").alias("value"), F.array_join("c_ops", SEP).alias("ops"))


@query("normalize_text")
def _(m):
    return cleaned_cells(texts(m), TEXT, "source", "id")


@query("clean_int")
def _(m):
    return cleaned_cells(messy_numbers(m.base("orders")), INT, "id", "raw")


@query("clean_price")
def _(m):
    return cleaned_cells(messy_numbers(m.base("orders")), DECIMAL, "id", "raw")


@query("date_split")
def _(m):
    df = m.raw("menu").select("id", F.col("date").alias("raw"))
    return cleaned_cells(df, DATE, "id", "raw").select("id", "raw", "value.*", "ops")


@query("currency_map")
def _(m):
    return cleaned_cells(m.raw("menu").select("id", F.col("currency").alias("raw")), CURRENCY, "id", "raw")


@query("unmapped_currencies")
def _(m):
    menus = m.trace("menu").snapshot()
    unmapped = menus.where(cleaning.unmapped_currency(F.col))
    return unmapped.groupBy("currency").agg(F.count(F.lit(1)).alias("menus"))


@query("fold_accents")
def _(m):
    return texts(m).select("source", "id", fold_accents(F.col("raw")).alias("value"))


@query("clean_name")
def _(m):
    return cleaned_cells(texts(m), NAME, "source", "id")


def _digits_masked(raw: pa.Array) -> tuple[pa.Array, dict[str, pa.Array]]:
    """Numbers inside names, such as sizes and brands, as the letter N."""
    value = pc.replace_substring_regex(raw, r"[0-9]+", "N")
    return value, {"digits_masked": pc.not_equal(value, raw)}


def user_chain(m: Menus) -> Trace:
    """A cleaner of the user's own, in Python over Arrow, before one of the built-in ones."""
    masked = Cleaner.from_arrow(_digits_masked, ("digits_masked",))
    stages = (Stage("mask-digits", (Apply("name", masked),)), Stage("dish-name", (Apply("name", NAME),)))
    dishes = fixtures.stamped(m.raw("dish").select("id", "name"), "dish")
    return run_stages("dish", dishes, stages)


@query("clean_custom")
def _(m):
    return user_chain(m).snapshot()


# --- provenance -------------------------------------------------------------
@query("row_stamp")
def _(m):
    return stamp_rows(m.base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"))


@query("row_log")
def _(m):
    return union(
        [t.snapshot().select(F.lit(t.table).alias("table"), V.SOURCE_ROW, "id", V.LOG) for t in m.traces()]
    )


@query("change_log")
def _(m):
    return m.changes().orderBy("table", "step", V.SOURCE_ROW, "column")


@query("stage_summary")
def _(m):
    return union([t.summary() for t in m.traces()])


@query("cleaning_log")
def _(m):
    return union([t.summary() for t in m.traces(scoped=True)])


@query("cleaning_log_totals")
def _(m):
    log = union([t.summary() for t in m.traces(scoped=True)])
    return log.groupBy("table").agg(
        F.count(F.lit(1)).alias("rules"), F.sum("rows_affected").alias("cell_changes")
    )


@query("drop_constant")
def _(m):
    return m.trace("menu", scoped=True).snapshot("drop-status")


@query("clean_menu")
def _(m):
    return m.trace("menu").cleaned()


@query("clean_menu_page")
def _(m):
    return m.trace("menu_page").cleaned()


@query("clean_menu_item")
def _(m):
    return m.trace("menu_item").cleaned()


@query("clean_dish")
def _(m):
    return m.trace("dish").cleaned()


@query("omit_rows")
def _(m):
    return m.trace("menu_item").snapshot(rows="omitted")


@query("winsorize")
def _(m):
    return m.trace("menu_item").snapshot("price-outlier")


@query("winsorize_dish")
def _(m):
    return m.trace("dish").snapshot("price-outlier")


@query("row_status")
def _(m):
    return union([row_status(t) for t in m.traces()])


@query("excluded_records")
def _(m):
    return m.excluded()


@query("row_accounting")
def _(m):
    return accounting.row_accounting({t: fixtures.stamped(m.raw(t), t) for t in TABLES}, m.kept(), m.excluded())


# --- scope and profile ------------------------------------------------------
@query("scope_menu")
def _(m):
    return cleaning.scope_menu(m.raw("menu"))


@query("scope_dish")
def _(m):
    return cleaning.scope_dish(m.raw("dish"))


@query("scope_waterfall")
def _(m):
    return cleaning.scope_waterfall(m.raw("menu"))


@query("profile")
def _(m):
    return union(
        [
            profile.profile(m.raw(t), t, tuple(c for c in V.RAW_COLUMNS[t] if c.endswith(("id", "price"))))
            for t in TABLES
        ]
    )


@query("id_health")
def _(m):
    columns = {"menu": ("id",), "menu_page": ("id", "menu_id"), "menu_item": ("id", "menu_page_id", "dish_id"), "dish": ("id",)}
    return union([profile.id_health(m.trace(t).snapshot(), t, c) for t, c in columns.items()])


@query("price_health")
def _(m):
    return union(
        [profile.price_health(m.trace(t).snapshot("price-decimal"), t, *V.WINSORIZE_COLUMNS[t]) for t in ("menu_item", "dish")]
    )


@query("price_quantile")
def _(m):
    found = []
    for table in ("menu_item", "dish"):
        cells = {c: F.col(c).try_cast("double") for c in V.WINSORIZE_COLUMNS[table]}
        rows = quantiles.exact_quantiles(
            m.trace(table).snapshot("price-decimal"), cells, [1 - x for x in V.CAP_LIMITS]
        )
        found.append(rows.select(F.lit(table).alias("table"), "column", F.round("prob", 4).alias("prob"), "total", F.round("value", 4).alias("value")))
    return union(found)


def _priced_cells(m: Menus, table: str) -> tuple[DataFrame, dict[str, Column]]:
    return m.trace(table).snapshot("price-decimal"), {c: F.col(c).try_cast("double") for c in V.WINSORIZE_COLUMNS[table]}


@query("price_quantile_sketch")
def _(m):
    """Quantiles of merged sketches, one built per table, column and eighth of the rows, against the exact ranks."""
    def built() -> DataFrame:
        found = []
        for table in ("menu_item", "dish"):
            rows, cells = _priced_cells(m, table)
            rows = rows.withColumn("part", F.pmod(F.col(V.SOURCE_ROW), F.lit(8)))
            found.append(sketches.quantile_sketches(rows, cells, ["part"]).select(F.lit(table).alias("table"), "*"))
        return union(found)

    stored = m.work.table("quantile_sketches", built)
    found = []
    for table in ("menu_item", "dish"):
        rows, cells = _priced_cells(m, table)
        merged = sketches.merged_quantiles(stored.where(F.col("table") == table), ["column"])
        estimates = sketches.estimated_quantiles(merged, [1 - x for x in V.CAP_LIMITS])
        errors = sketches.rank_errors(rows, cells, estimates)
        found.append(errors.select(F.lit(table).alias("table"), "column", F.round("prob", 4).alias("prob"), "total", (F.col("rank_error") <= sketches.RANK_BOUND).alias("within_bound")))
    return union(found)


#: Columns of one meaning and where they occur.
ID_COLUMNS = {
    "menu": (("menu", "id"), ("menu_page", "menu_id")),
    "menu_page": (("menu_page", "id"), ("menu_item", "menu_page_id")),
    "dish": (("dish", "id"), ("menu_item", "dish_id")),
}


@query("distinct_sketch")
def _(m):
    """Distinct ids per column and over the columns of one meaning, from stored and united sketches."""
    cells = [(kind, t, c, m.trace(t).snapshot()) for kind, places in ID_COLUMNS.items() for t, c in places]

    def built() -> DataFrame:
        made = [sketches.distinct_sketches(rows, {c: F.col(c)}, []).select(F.lit(kind).alias("kind"), F.lit(f"{t}.{c}").alias("place"), "sketch") for kind, t, c, rows in cells]
        return union(made)

    stored = m.work.table("distinct_sketches", built)
    everywhere = sketches.united(stored, ["kind"]).select("kind", F.lit("all").alias("place"), "sketch")
    estimates = sketches.estimated_distinct(stored.unionByName(everywhere))
    values = union([rows.select(F.lit(kind).alias("kind"), F.lit(f"{t}.{c}").alias("place"), F.col(c).alias("value")) for kind, t, c, rows in cells])
    exact = values.groupBy("kind", "place").agg(F.count_distinct("value").alias("exact"))
    exact = exact.unionByName(values.groupBy("kind").agg(F.lit("all").alias("place"), F.count_distinct("value").alias("exact")))
    off = F.abs(F.col("estimate") - F.col("exact"))
    return exact.join(estimates, ["kind", "place"]).select(
        "kind", "place", "exact", (off <= sketches.DISTINCT_BOUND * F.col("exact")).alias("within_bound")
    )


@query("year_range")
def _(m):
    return m.trace("menu").snapshot().agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("year").alias("dated"), F.count_if(F.col("year").isNull()).alias("undated")
    )


@query("name_collapse")
def _(m):
    return profile.name_collapse(m.raw("dish"), m.trace("dish").snapshot())


#: Part names as they get transcribed: reversed with a comma, shouted with a dot, or plain.
PART_NAME = """case p_partkey % 3
    when 0 then concat(split_part(p_name, ' ', 2), ', ', split_part(p_name, ' ', 1))
    when 1 then concat(upper(p_name), '.') else p_name end"""


def _names(m: Menus) -> DataFrame:
    return m.base("part").select(F.expr(PART_NAME).alias("name"))


def _fingerprint(name: Column) -> Column:
    return keys.fingerprint(keys.folded_lower(name))


@query("cluster_fingerprint")
def _(m):
    return clusters.clusters(clusters.variants(_names(m), "name", _fingerprint))


@query("cluster_members")
def _(m):
    return clusters.cluster_members(clusters.variants(_names(m), "name", _fingerprint))


def _part_names(m: Menus) -> DataFrame:
    return m.base("part").select(F.col("p_partkey").alias("id"), F.expr(PART_NAME).alias("name"))


def _merges(m: Menus) -> DataFrame:
    """Accepted merges of part names: spellings of one name, then names that share their first word.

    The second kind starts where the first ends, so links form chains.
    """
    def build() -> DataFrame:
        spelt = clusters.accepted_merges(clusters.cluster_members(clusters.variants(_part_names(m), "name", _fingerprint)), "fingerprint")
        plain = clusters.apply_merges(_part_names(m), "name", spelt).select(F.col("merged").alias("name"))
        heads = clusters.variants(plain, "name", lambda name: F.substring_index(_fingerprint(name), " ", 1))
        links = spelt.unionByName(clusters.accepted_merges(clusters.cluster_members(heads), "head"))
        return clusters.resolve_merges(links, lambda df, name: m.work.table(name, lambda: df))

    return m.work.table("accepted_merges", build)


@query("cluster_apply")
def _(m):
    return clusters.apply_merges(_part_names(m), "name", _merges(m))


@query("cluster_effect")
def _(m):
    return clusters.merge_effect(_part_names(m), "name", _merges(m))


@query("cluster_phonetic")
def _(m):
    names = m.trace("dish").snapshot()
    found = []
    for method in (keys.soundex, keys.cologne, keys.metaphone):
        groups = clusters.clusters(clusters.variants(names, "name", method))
        found.append(groups.select(F.lit(method.__name__).alias("method"), "*"))
    return union(found)


# --- checks -----------------------------------------------------------------
def _integrity(rule: checks.IntegrityRule) -> Callable[[Menus], DataFrame]:
    return lambda m: rule.violations(m.staged_table(rule.table, False))


for _rule in checks.INTEGRITY_RULES:
    query(_rule.rule_id.lower().replace("-", "_"))(_integrity(_rule))


def _dependency(rule: str) -> Callable[[Menus], DataFrame]:
    table, key, attributes = checks.FD_KEYS[rule]
    return lambda m: checks.fd_violations(m.with_copies(table), rule, key, attributes)


for _name in checks.FD_KEYS:
    query(_name.lower().replace("-", "_"))(_dependency(_name))


@query("fd_4")
def _(m):
    return checks.price_conflicts(m.staged_table("menu_item", False))


@query("fd_4_prices")
def _(m):
    return checks.conflict_prices(m.staged_table("menu_item", False))


@query("report_name_ids")
def _(m):
    return checks.fd_report(m.staged_table("dish", False), "name", "id", "id_values")


@query("report_dish_prices")
def _(m):
    return checks.fd_report(m.staged_table("menu_item", False), "dish_id", "price", "price_values")


@query("report_menu_pages")
def _(m):
    return checks.fd_report(m.staged_table("menu_page", False), "menu_id", "id", "id_values")


def _inclusion(rule: str) -> Callable[[Menus], DataFrame]:
    return lambda m: staging.ind_results(m.staged())[rule]


for _name in ("IND-1", "IND-2", "IND-3"):
    query(_name.lower().replace("-", "_"))(_inclusion(_name))


@query("ind_3_ignore_nulls")
def _(m):
    return staging.ind_results(m.staged(), nulls="ignore")["IND-3"]


@query("ind_4")
def _(m):
    """Final items, with copies that point to no menu for every tenth item, against all final menus."""
    tables = m.repaired()
    items = staging.final_item(tables)
    dangling = items.where("menu_item_id % 10 = 0").withColumn("menu_id", -F.col("menu_id") - 1)
    return checks.ind_violations(items.unionByName(dangling), "menu_id", staging.final_menu(tables), "menu_id")


@query("ind_report")
def _(m):
    return staging.ind_report(m.staged())


@query("load_cascade")
def _(m):
    return staging.load(m.staged())["menu_item"]


@query("violation_report")
def _(m):
    return validation.violations(m.loaded())


@query("violation_counts")
def _(m):
    return m.rule_counts()


@query("violation_delta")
def _(m):
    return validation.violation_delta(m.rule_counts())


@query("validation_report")
def _(m):
    return validation.validation_report(m.rule_counts())


@query("iteration_metrics")
def _(m):
    return passes.iteration_metrics(m.passes())


# --- repair, final tables, analysis -----------------------------------------
@query("ic8_repair")
def _(m):
    return repair.repair_zero_prices(m.staged_table("menu_item", False))


@query("fd4_repair")
def _(m):
    return repair.repair_items(m.staged_table("menu_item", False))


@query("final_menu")
def _(m):
    return staging.final_menu(m.repaired())


@query("final_item")
def _(m):
    return staging.final_item(m.repaired())


@query("price_fallback")
def _(m):
    return m.priced()


@query("price_source_counts")
def _(m):
    return pricing.price_source_counts(m.priced())


@query("final_item_priced")
def _(m):
    tables = m.repaired()
    priced = pricing.fallback_prices(tables["menu_item"], tables["dish"])
    return staging.final_item_priced(priced, tables["menu_page"])


@query("menu_avg")
def _(m):
    return m.averages()


@query("menu_avg_decade")
def _(m):
    return m.averages(pricing.decade_period)


@query("price_tier")
def _(m):
    return pricing.price_tiers(m.averages())


@query("top_menus")
def _(m):
    return pricing.top_menus(m.averages())


@query("top_span")
def _(m):
    """Dishes (parts) with the longest time between first and last appearance."""
    return pricing.longest_running(m.base("lineitem"), "l_partkey", "l_shipdate", 20)


@query("menu_items")
def _(m):
    raw = {t: m.raw(t) for t in TABLES}
    return pricing.items_of_menus(raw["menu_item"], raw["menu_page"], raw["dish"])


@query("cap_sensitivity")
def _(m):
    tables = m.staged()
    return pricing.cap_sensitivity(
        staging.typed("menu_item", m.trace("menu_item").snapshot("price-decimal")), tables["menu_page"], tables["menu"]
    )
