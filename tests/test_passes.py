"""Repair ledgers, passes to a fixed point, counts carried on, and the books of every row."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from scrubline.operators import accounting, repair
from scrubline.plans import passes, staging, validation

PROVENANCE = "source_file string, source_row_num bigint"
SCHEMAS = {t: f"{', '.join(c)}, {PROVENANCE}" for t, c in staging.STAGED.items()}


def frames(spark, **rows):
    """Staged tables; rows come without provenance and are numbered."""
    return {
        t: spark.createDataFrame([(*r, f"{t}.csv", i) for i, r in enumerate(rows.get(t, []), 1)], schema)
        for t, schema in SCHEMAS.items()
    }


def store_of(spark):
    """Written under a counted name, as in a run."""
    import tempfile

    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def store(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return store


def dirty(seed=5, n=600):
    """Tables with missing parents, repeated keys, zero, blank and conflicting prices, a third on one page."""
    rng = random.Random(seed)
    menus = [(k, rng.choice(["USD", None]), rng.choice([1900, 1700, None]), 1, 1) for k in range(20)] + [(3, "USD", 1950, 2, 2)]
    pages = [(k, rng.randrange(25)) for k in range(60)] + [(7, 3), (None, 4)]
    dishes = [(k, f"D{k % 7}", rng.choice([None, 1.0, 2000.0]), 2.0) for k in range(6)] + [(2, "D2", 1.0, 2.0)]
    items = []
    for k in range(n):
        page = 1 if k % 3 == 0 else rng.choice([None, *range(70)])
        items.append((k, page, rng.choice([None, 0.0, 1.0, 2.5, -1.0]), rng.choice([None, 0.0, 3.0, -2.0]), rng.choice([None, 1, 2, 9])))
    return dict(menu=menus, menu_page=pages, menu_item=items + items[:9], dish=dishes)


def test_ledger_gives_what_the_repairs_give(spark):
    rows = dirty()["menu_item"][:600]
    items = frames(spark, menu_item=rows)["menu_item"].repartition(5)
    ledger = repair.repair_ledger(items)
    assert ledger.count() == 600
    got = sorted(map(str, repair.after_repair(ledger, items.columns).collect()))
    assert got == sorted(map(str, repair.repair_items(items).collect()))
    lost = ledger.where("removed").collect()
    kept = {r.source_row_num: r for r in ledger.where("not removed").collect()}
    assert {r.rule for r in lost} == {"D3", "D4", "D5"}
    for r in lost:
        assert (r.kept_source_row_num is not None) == (r.rule == "D4")
        if r.rule == "D4":
            stays = kept[r.kept_source_row_num]
            assert (stays.rule, stays.menu_page_id, stays.dish_id) == ("D4", r.menu_page_id, r.dish_id)


def test_rows_that_share_an_id_are_told_apart(spark):
    rows = [(1, 1, 2.0, None, 1), (1, 1, 4.0, None, 1), (1, 1, None, None, 1), (None, 1, 5.0, None, 1)]
    ledger = {r.source_row_num: r for r in repair.repair_ledger(frames(spark, menu_item=rows)["menu_item"]).collect()}
    assert [ledger[k].removed for k in (1, 2, 3, 4)] == [False, True, True, True]
    assert ledger[1].new_price == pytest.approx(11 / 3, abs=1e-9) and {ledger[k].kept_source_row_num for k in (2, 3, 4)} == {1}


ALL = {**passes.DISPOSITIONS, "IC-3": "exclude", "IC-7": "exclude", "IC-9": "exclude", "IC-15": "exclude"}


def test_carried_counts_equal_full_ones(spark):
    done = passes.repair_passes(frames(spark, **dirty()), store_of(spark), ALL)
    assert len(done) > 2
    for p in done:
        full = {r.rule_id: r.violations for r in validation.rule_counts(passes.data(p.tables), p.number).collect()}
        assert {r.rule_id: r.violations for r in p.counts.collect()} == full
    left = {r.rule_id: r.violations for r in done[-1].counts.collect()}
    # Groups on a page that isn't known keep their prices, and no repair touches their blanks.
    assert all(left[r] == 0 for r in ALL if r != "FD-4")


def test_three_passes_to_a_fixed_point(spark):
    tables = frames(
        spark,
        menu=[(1, "USD", 1900, 1, 1), (2, "USD", 1700, 1, 1)],
        menu_page=[(10, 1), (20, 2)],
        dish=[(1, "SOUP", 1.0, 2.0)],
        menu_item=[(100, 10, -1.0, 5.0, 1), (101, 10, 1.0, 5.0, 1), (200, 20, 3.0, None, 1)],
    )
    done = passes.repair_passes(tables, store_of(spark), {**passes.DISPOSITIONS, "IC-3": "exclude"})
    got = [
        (r.iteration, r.rows_repaired, r.rows_excluded, r.item_rows, r.change_in_eligible_items, r.change_in_eligible_menus)
        for r in passes.iteration_metrics(done).orderBy("iteration").collect()
    ]
    # 1: the conflict's mean is zero, the menu goes; 2: the zero takes the high price, the page goes; 3: its item goes.
    assert got == [(0, 0, 0, 3, None, None), (1, 1, 2, 2, -2, -2), (2, 1, 1, 2, 1, 1), (3, 0, 1, 1, 0, 0)]
    (item,) = done[-1].tables["menu_item"].collect()
    assert (item.id, item.price) == (100, 5.0)
    lost = {(r.table, r.row_key, r.rule, r.iteration) for f in passes.excluded_in(done) for r in f.collect()}
    assert lost == {("menu", "2", "IC-3", 1), ("menu_item", "101", "D4", 1), ("menu_page", "20", "IND-1", 2), ("menu_item", "200", "IND-2", 3)}
    delta = {r.rule_id: (r.before_repair, r.after_repair) for r in validation.violation_delta(passes.all_counts(done)).collect()}
    assert delta["IC-3"] == (1, 0) and delta["FD-4"] == (1, 0) and delta["IC-15"] == (0, 0)


def test_clean_tables_take_no_pass(spark):
    done = passes.repair_passes(frames(spark), store_of(spark))
    assert len(done) == 1
    assert passes.iteration_metrics(done).first().violations_remaining == 0
    report = validation.validation_report(passes.all_counts(done))
    assert {r.outcome for r in report.collect()} == {"holds"} and report.count() == 25


def test_a_bounded_loop_warns(spark):
    with pytest.warns(UserWarning, match="after 1 passes"):
        passes.repair_passes(frames(spark, **dirty()), store_of(spark), ALL, most=1)


def test_recount_aggregates_only_touched_keys(spark):
    """All dependency counts stand on rows that were met with the touched keys first."""
    tables = passes.data(frames(spark, **dirty()))
    counts = spark.createDataFrame([(0, "FD", "FD-3", 4)], "iteration int, family string, rule_id string, violations long")
    gone = {"menu_item": tables["menu_item"].where("id = 3")}
    come = {"menu_item": tables["menu_item"].where("id = 3").withColumn("price", F.lit(9.0))}
    plan = validation.recount(counts, tables, tables, gone, come, 1)._jdf.queryExecution().optimizedPlan().toString()
    # FD-3 and FD-4, before and after; rules of other tables aren't looked at.
    assert "FD-1" not in plan and "FD-5" not in plan and "IND-1" not in plan and "IC-1 " not in plan
    assert plan.count("Join LeftSemi, (id") >= 2 and plan.count("Join LeftSemi, ((menu_page_id") >= 2


def test_books_notice_what_is_lost_doubled_or_unknown(spark):
    row = lambda *numbers: spark.createDataFrame([("f.csv", n) for n in numbers], PROVENANCE)
    gone = lambda *lines: spark.createDataFrame(
        [("t", "f.csv", n, str(n), "rule", 0, "f.csv" if k else None, k) for n, k in lines],
        f"table string, {PROVENANCE}, row_key string, rule string, iteration int, kept_source_file string, kept_source_row_num bigint",
    )
    book = lambda given, kept, lines: accounting.row_accounting({"t": given}, {"t": kept}, gone(*lines)).first()
    good = book(row(1, 2, 3, 4), row(1, 2), [(3, 1), (4, None)])
    assert (good.input_rows, good.kept_rows, good.excluded_rows, good.merged_rows, good.balanced) == (4, 2, 2, 1, True)
    lost = book(row(1, 2, 3), row(1), [(3, None)])
    assert (lost.lost_rows, lost.balanced) == (1, False)
    # Sums alone would agree here.
    twice = book(row(1, 2, 3), row(1, 2), [(2, None)])
    assert (twice.lost_rows, twice.doubled_rows, twice.balanced) == (1, 1, False)
    stray = book(row(1, 2), row(1), [(2, 7)])
    assert (stray.stray_rows, stray.balanced) == (1, False)
