"""Joins, ranks, quantiles, checks and repairs against brute force, hot groups included."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scrubline.operators import checks, clusters, pricing, ranking, repair
from scrubline.operators.quantiles import exact_quantiles
from scrubline.operators.skew import join_groups

ITEM = "id bigint, menu_page_id bigint, price double, high_price double, dish_id bigint"


def hot_items(n=4000, seed=7):
    """A third of all lines on one page and dish, NULL pages and dishes, many duplicates."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        hot = i % 3 == 0
        page = 1 if hot else rng.choice([None, *range(2, 300)])
        dish = 1 if hot else rng.choice([None, 1, 2, 3])
        price = rng.choice([None, 0.0, 1.0, 2.5, 2.5, 7.25])
        high = rng.choice([None, 0.0, 3.0, 8.5])
        rows.append((i, page, price, high, dish))
    return rows


def repaired_by_hand(rows):
    kept = []
    for i, page, price, high, dish in rows:
        if price == 0 and high == 0:
            continue
        kept.append([i, page, high if price == 0 else price, high, dish])
    groups = defaultdict(list)
    for r in kept:
        if r[4] is not None:
            groups[r[1], r[4]].append(r)
    out = {r[0]: r for r in kept}
    for (page, _), lines in groups.items():
        priced = [r for r in lines if r[2] is not None]
        distinct = {r[2] for r in priced}
        if len(distinct) > 1:
            keep = min(priced)[0]
            highs = {r[3] for r in priced if r[3] is not None}
            out[keep][2] = sum(distinct) / len(distinct)
            out[keep][3] = sum(highs) / len(highs) if highs else None
            if page is not None:
                for r in lines:
                    if r[0] != keep:
                        out.pop(r[0])
        elif len(distinct) == 1 and page is not None:
            for r in lines:
                if r[2] is None:
                    out.pop(r[0])
    return sorted(tuple(r) for r in out.values())


def test_repair_matches_hand_work_with_a_hot_group(spark):
    rows = hot_items()
    df = spark.createDataFrame(rows, ITEM).repartition(7)
    got = sorted(tuple(r) for r in repair.repair_items(df).collect())
    want = repaired_by_hand(rows)
    assert [g[:2] + g[4:] for g in got] == [w[:2] + w[4:] for w in want]
    for g, w in zip(got, want):
        for got_mean, mean in zip(g[2:4], w[2:4]):  # means are rounded to nine decimals
            assert got_mean == (mean if mean is None else pytest.approx(mean, abs=1e-9))


def test_repair_takes_any_price(spark):
    rows = [(1, 1, 1e30, None, 1), (2, 1, 3e30, None, 1), (3, 2, 1.0, None, 1), (4, 2, 0.0, 0.5, 1), (5, 2, None, 1 / 3, 1)]
    got = {r.id: r.price for r in repair.repair_items(spark.createDataFrame(rows, ITEM)).collect()}
    assert got == {1: pytest.approx(2e30), 3: 0.75}
    (mean,) = spark.createDataFrame([(1 / 3,)], "p double").agg(pricing.mean_price(F.col("p"))).first()
    assert mean == 0.333333333


def test_repair_leaves_no_conflict_behind(spark):
    df = spark.createDataFrame(hot_items(), ITEM)
    fixed = repair.repair_items(df)
    assert fixed.where("price = 0").count() == 0
    assert checks.price_conflicts(fixed).where("menu_page_id is not null").count() == 0


def test_repair_keeps_extra_columns(spark):
    df = spark.createDataFrame(hot_items(300), ITEM).withColumn("note", F.concat(F.lit("n"), "id"))
    fixed = repair.repair_items(df)
    assert fixed.columns == df.columns
    assert fixed.where("note != concat('n', id)").count() == 0


def test_price_conflicts_by_hand(spark):
    rows = hot_items()
    groups = defaultdict(list)
    for _, page, price, _, dish in rows:
        if dish is not None:
            groups[page, dish].append(price)
    mixed = {k: v for k, v in groups.items() if len(set(v)) > 1}
    real = lambda v: [p for p in v if p is not None]
    want = {k: (len(v), len(set(v)), min(real(v)), max(real(v))) for k, v in mixed.items()}
    items = spark.createDataFrame(rows, ITEM)
    got = checks.price_conflicts(items).collect()
    assert {
        (r.menu_page_id, r.dish_id): (r.line_count, r.distinct_prices, r.low_price, r.high_price) for r in got
    } == want
    listed = {(r.menu_page_id, r.dish_id, r.price): r.n for r in checks.conflict_prices(items).collect()}
    assert listed == {(*k, p): v.count(p) for k, v in mixed.items() for p in set(v)}


def test_long_groups_have_the_same_form_as_short_ones(spark):
    df = spark.range(30_001).select(
        "id", F.lit(1).alias("menu_page_id"), F.when(F.col("id") % 2 == 0, 1.5).otherwise(2.0).alias("price"),
        F.lit(None).cast("double").alias("high_price"), F.lit(1).alias("dish_id"),
    )
    (row,) = checks.price_conflicts(df).collect()
    assert (row.line_count, row.priced_lines, row.low_price, row.high_price) == (30_001, 30_001, 1.5, 2.0)
    assert sorted((r.price, r.n) for r in checks.conflict_prices(df).collect()) == [(1.5, 15_001), (2.0, 15_000)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_join_groups_equals_a_plain_join(spark, how):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 2500).alias("k"), "id"
    )
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    got = join_groups(rows, groups, ["k"], "n", how)
    plain = rows.join(groups.withColumnRenamed("k", "g"), F.col("k").eqNullSafe(F.col("g")), how).drop("g")
    assert got.columns == plain.columns
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


@pytest.mark.parametrize("parts", [1, 5, 23])
def test_ranks_equal_a_window(spark, parts):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 1900).otherwise(1800 + F.col("id") % 40).cast("int").alias("period"),
        (F.col("id") % 17).cast("double").alias("avg_price"), F.col("id").alias("menu_id"), F.lit(1).alias("item_count"),
    ).repartition(parts)
    got = pricing.price_tiers(df)
    window = Window.partitionBy("period").orderBy("avg_price", "menu_id")
    want = df.select("menu_id", "period", "item_count", "avg_price", F.ntile(4).over(window).alias("tier"))
    want = want.withColumn("label", F.repeat(F.lit("$"), F.col("tier")))
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 5000


def test_tiles_of_small_groups(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(3)] + [(2, 9, 1.0)], "g int, id int, v double")
    tiles = ranking.ranked(df, "g", [F.col("v"), F.col("id")]).withColumn("t", ranking.tile(4))
    assert sorted((r.g, r.id, r.t) for r in tiles.collect()) == [(1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 9, 1)]


def test_quantiles_equal_numpy(spark):
    rng = random.Random(3)
    values = [0.4] * 3000 + [round(rng.lognormvariate(1, 3), 2) for _ in range(4000)] + [-1.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(9)
    probs = [0.0, 0.25, 0.5, 0.95, 0.995, 0.999, 1.0]
    got = {r.prob: r.value for r in exact_quantiles(df, {"v": F.col("v")}, probs).collect()}
    positive = [v for v in values if v > 0]
    assert [got[p] for p in probs] == pytest.approx([np.quantile(positive, p) for p in probs], rel=1e-12)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(-1.0,)], "v double"), {"v": F.col("v")}, [0.5]).count() == 0


def test_dependency_checks_see_null_keys_and_null_values(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (2, None), (None, "x"), (None, "y"), (3, "z")]
    df = spark.createDataFrame(rows, "id int, v string")
    got = {r.id: (r.row_count, r.n, r.disposition) for r in checks.fd_violations(df, "FD", ["id"], {"v": "n"}).collect()}
    assert got == {1: (2, 1, "duplicate_load"), 2: (2, 2, "fd_violation"), None: (2, 2, "fd_violation")}


def test_inclusion_checks_and_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, fk int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    found = lambda **kw: sorted(r.id for r in checks.ind_violations(child, "fk", parent, **kw).collect())
    assert found() == [2, 3] and found(nulls="ignore") == [3]
    assert [r.id for r in checks.ind_kept(child, "fk", parent).collect()] == [1]


def test_integrity_rules_on_bad_rows(spark):
    tables = {
        "menu": spark.createDataFrame(
            [(1, "USD", "1900", "1", "1"), (None, "F", "1850", "13", "0"), (3, None, None, "x", "1.5")],
            "id int, currency string, year string, month string, day string",
        ),
        "menu_item": spark.createDataFrame(
            [(1, 1, 0.0, -1.0, 1), (None, None, None, 0.0, None), (2, 1, 2.0, 0.0, 1)], ITEM
        ),
        "menu_page": spark.createDataFrame([(None, 1), (1, None), (2, 2)], "id int, menu_id int"),
        "dish": spark.createDataFrame(
            [(1, "A", 5.0, 4.0), (None, "B", -1.0, 3101.0), (2, "C", 1101.0, None)],
            "id int, name string, lowest_price double, highest_price double",
        ),
    }
    got = {r.rule_id: r.violations(tables[r.table]).count() for r in checks.INTEGRITY_RULES}
    assert got == {
        "IC-1": 1, "IC-2": 2, "IC-3": 2, "IC-4": 2, "IC-5": 2, "IC-6": 1, "IC-7": 1, "IC-8": 1, "IC-9": 1,
        "IC-10": 1, "IC-11": 1, "IC-12": 1, "IC-13": 1, "IC-14": 1, "IC-15": 2, "IC-16": 2, "IC-17": 1,
    }


def test_every_fallback_path(spark):
    dishes = spark.createDataFrame(
        [(1, 2.0, 4.0), (2, 2.0, 0.0), (3, None, 5.0), (4, 0.0, -1.0)], "id int, lowest_price double, highest_price double"
    )
    items = [(1, 9.0, 1.0, 1), (2, 0.0, 8.0, 1), (3, None, None, 1), (4, -1.0, None, 2), (5, None, 0.0, 3), (6, None, None, 4), (7, None, None, None)]
    df = spark.createDataFrame([(i, 1, p, h, d) for i, p, h, d in items], ITEM)
    priced = pricing.fallback_prices(df, dishes)
    assert {r.id: (r.clean_price_candidate, r.price_source) for r in priced.collect()} == {
        1: (9.0, "menu_item_price"), 2: (8.0, "menu_item_high_price"), 3: (3.0, "dish_lowest_highest_average"),
        4: (2.0, "dish_lowest_price"), 5: (5.0, "dish_highest_price"), 6: (None, "no_valid_price"), 7: (None, "no_valid_price"),
    }
    counts = {r.price_source: r.items for r in pricing.price_source_counts(priced).collect()}
    assert sum(counts.values()) == 7 and counts["no_valid_price"] == 2


def test_cluster_members_of_a_hot_key(spark):
    names = spark.range(6000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("key"), F.concat(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 900)), F.lit("v"), "id").alias("name"))
    found = clusters.variants(names, "name", lambda name: F.when(name.startswith("hot"), "hot").otherwise(F.substring_index(name, "v", 1)))
    members = clusters.cluster_members(found)
    assert members.count() == 6000
    assert members.where("cluster_key = 'hot'").agg(F.max("variants"), F.count("*")).first() == (3000, 3000)


def test_phonetic_clusters_by_hand(spark):
    from scrubline.plans.catalog import QUERIES, Menus
    from scrubline.functions import keys

    sf_dir = "/root/testdata/sf0.001"
    names = Menus.of(spark, sf_dir).trace("dish").snapshot()
    coded = names.select("name", keys.soundex(F.col("name")).alias("key")).collect()
    by_key = defaultdict(set)
    for r in coded:
        by_key[r.key].add(r.name)
    got = {r.cluster_key: r.variants for r in QUERIES["cluster_phonetic"](spark, sf_dir).where("method = 'soundex'").collect()}
    assert got == {k: len(v) for k, v in by_key.items() if len(v) > 1}


def test_skewed_foreign_key_is_split(spark):
    """A join on a key that a third of all rows share: the skewed partition is split at run time."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 400_000, numPartitions=16).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("fk"))
        parent = spark.range(10, 4000).select(F.col("id"))
        orphans = checks.ind_violations(child, "fk", parent)
        n = len(orphans.collect())
        assert "skew=true" in orphans._jdf.queryExecution().executedPlan().toString()
        assert n == child.where("fk < 10 or fk >= 4000").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
