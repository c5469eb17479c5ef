"""Accepted merges, stored sketches, cleaners in Python workers, phonetic codes told letter by letter."""

from __future__ import annotations

import random
import tempfile

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from oracles.build import phonetic
from scrubline.functions import Cleaner, keys
from scrubline.operators import clusters, sketches
from scrubline.operators.stages import Apply, Stage, run_stages
from scrubline.sources import fixtures

LINK = "variant string, canonical string, cluster_id string, method string"


def keep(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def store(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return store


def resolved(spark, pairs):
    links = spark.createDataFrame([(a, b, f"c{k}", "m") for k, (a, b) in enumerate(pairs)], LINK)
    return {r.variant: r.canonical for r in clusters.resolve_merges(links, keep(spark)).collect()}


def resolved_by_hand(pairs):
    to = {}
    for a, b in pairs:
        if a != b:
            to[a] = min(b, to.get(a, b))
    out = {}
    for a in to:
        seen, at = [], a
        while at in to and at not in seen:
            seen.append(at)
            at = to[at]
        out[a] = min(seen[seen.index(at) :]) if at in seen else at
    return {a: b for a, b in out.items() if a != b}


def test_chains_and_circles_of_merges(spark):
    chain = [(f"n{k:03}", f"n{k + 1:03}") for k in range(37)]
    circle = [("z1", "z2"), ("z2", "z3"), ("z3", "z1"), ("a-tail", "z2"), ("a-longer", "a-tail")]
    other = [("x", "x"), ("p", "r"), ("p", "q"), ("q", "r"), ("self", "self")]
    for pairs in (chain, circle, other, chain + circle + other, []):
        assert resolved(spark, pairs) == resolved_by_hand(pairs)
    rng = random.Random(6)
    pairs = [(str(rng.randrange(300)), str(rng.randrange(300))) for _ in range(260)]
    assert resolved(spark, pairs) == resolved_by_hand(pairs)


def test_merges_reach_the_rows_of_a_hot_value(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("v"), F.col("id") % 40)).alias("name"))
    merges = spark.createDataFrame([("HOT", "hot", "m:1", "m"), ("v1", "v2", "m:2", "m"), ("unused", "v9", "m:3", "m")], LINK)
    got = clusters.apply_merges(rows, "name", merges)
    to = {"HOT": ("hot", "m:1"), "v1": ("v2", "m:2")}
    assert got.count() == 6000
    assert all((r.merged, r.cluster_id) == to.get(r.name, (r.name, None)) for r in got.collect())
    effect = {r.cluster_id: (r.canonical, r.merged_variants, r.rows_affected) for r in clusters.merge_effect(rows, "name", merges).collect()}
    assert effect == {"m:1": ("hot", 1, 2000), "m:2": ("v2", 1, rows.where("name = 'v1'").count()), "m:3": ("v9", 1, 0)}


def test_quantile_sketches_merge_over_runs(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = spark.range(60_000).select((F.col("id") % 6).alias("part"), (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7.0 - 3).alias("v"))
    for run in ("a", "b"):
        half = rows.where(F.col("part") < 3 if run == "a" else F.col("part") >= 3)
        sketches.save_run(sketches.quantile_sketches(half, {"v": F.col("v")}, ["part"]), path, run)
    sketches.save_run(sketches.quantile_sketches(rows.where("part >= 3"), {"v": F.col("v")}, ["part"]), path, "b")
    saved = sketches.saved_runs(spark, path)
    assert saved.count() == 6
    probs = [0.01, 0.5, 0.9, 0.995]
    found = sketches.estimated_quantiles(sketches.merged_quantiles(saved, ["column"]), probs)
    errors = sketches.rank_errors(rows, {"v": F.col("v")}, found).collect()
    assert len(errors) == 4 and all(r.total == rows.where("v > 0").count() for r in errors)
    assert all(r.rank_error <= sketches.RANK_BOUND for r in errors)
    wrong = found.withColumn("estimate", F.col("estimate") * 2 + 1)
    assert max(r.rank_error for r in sketches.rank_errors(rows, {"v": F.col("v")}, wrong).collect()) > 0.3


def test_distinct_sketches_unite(spark):
    rows = spark.range(50_000).select((F.col("id") % 4).alias("part"), (F.col("id") % 20_000).alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    made = sketches.distinct_sketches(rows, {"a": F.col("a"), "b": F.when(F.col("b") != "3", F.col("b"))}, ["part"])
    all_parts = {r.column: r.estimate for r in sketches.estimated_distinct(sketches.united(made, ["column"])).collect()}
    assert all_parts["a"] == pytest.approx(20_000, rel=sketches.DISTINCT_BOUND) and all_parts["b"] == 6


def test_a_python_cleaner_runs_once_in_a_chain(spark):
    calls = spark.sparkContext.accumulator(0)

    def shout(raw: pa.Array):
        calls.add(len(raw))
        value = pc.utf8_upper(raw)
        return value, {"shouted": pc.not_equal(value, raw)}

    cleaner = Cleaner.from_arrow(shout, ("shouted",))
    raw = spark.createDataFrame([(str(k), x) for k, x in enumerate(["ab", "AB", None, "é!"])], "id string, name string")
    trace = run_stages("any", fixtures.stamped(raw, "any"), (Stage("s", (Apply("name", cleaner),)),))
    rows = trace.snapshot().where("name is null or name <> 'nothing'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    got = {r.id: (r.name, r.log) for r in rows.collect()}
    assert got == {"0": ("AB", "name:shouted"), "1": ("AB", ""), "2": (None, ""), "3": ("É!", "name:shouted")}
    assert calls.value == 4
    summary = {r.operation: r.rows_affected for r in trace.summary().collect()}
    assert summary == {"shouted": 2} and trace.changes().count() == 2


def test_phonetic_codes_of_any_word(spark):
    rng = random.Random(11)
    words = {"".join(rng.choice("ABCDEFGHIKLMNOPRSTUWXYZCHSGT") for _ in range(rng.randint(0, 9))) for _ in range(6000)}
    words |= {a + b + c for a in ("KN", "GN", "PN", "AE", "WR", "X", "WH", "SCH", "TCH", "GH", "DG", "MB") for b in ("", "A", "E", "T", "H") for c in ("", "MB", "GN", "GNED", "CIA", "WH", "YH")}
    words = sorted(words)
    frame = spark.createDataFrame([(w,) for w in words], "name string")
    got = {r[0]: tuple(r)[1:] for r in frame.select("name", *(f(F.col("name")) for f in (keys.soundex, keys.cologne, keys.metaphone))).collect()}
    con = duckdb.connect()
    con.register("words", pa.table({"name": words}))
    want = {r[0]: r[1:] for r in con.execute(f"with {phonetic('words', 'name')} select name, soundex, cologne, metaphone from ph").fetchall()}
    assert [(w, got[w], want[w]) for w in words if got[w] != want[w]][:5] == []


PUBLISHED = {
    "Robert": ("R163", "RBRT"), "Ashcraft": ("A261", "AXKRFT"), "Tymczak": ("T522", "TMKSK"), "Pfister": ("P236", "PFSTR"),
    "Knight": ("K523", "NT"), "Knuth": ("K530", "N0"), "Whale": ("W400", "WL"), "Lamb": ("L510", "LM"),
}


def test_published_codes(spark):
    frame = spark.createDataFrame([(w,) for w in PUBLISHED], "w string")
    got = frame.select("w", keys.soundex(F.col("w")), keys.metaphone(F.col("w"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == PUBLISHED
