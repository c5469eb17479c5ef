"""Each stage against a brute-force version of its rule, over its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from awkward_tables import SF_DIR
from pyspark.sql import functions as F
from scrubline.llm import mixing as sources
from scrubline.llm import toxicity
from scrubline.llm.storage import row_key, scratch
from test_llm_operators import brute_components, brute_hits, check_mix, check_shards


def test_stages(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, folder = rows.columns, scratch(spark)
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in rows.collect()]
        scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(rows, labels).collect()} if name == "toxicity" else {}
        rows_before = rows
        stage(spark, rows, SF_DIR).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
        if name != "sharding":
            assert rows.columns == columns
            after = Counter((r["doc_id"], r["text"]) for r in rows.collect())
        if name == "toxicity":
            assert after == Counter(r for r in before if not scores[r[0]])
        elif name == "near_dedup":
            kept = {k[0] for k in brute_components(before) if k[3]}
            assert after == Counter(r for r in before if r[0] in kept)
        elif name == "decontamination":
            gone = {k[0] for k in brute_hits(before, benchmark) if k[5]}
            assert gone and after == Counter(r for r in before if r[0] not in gone)
        elif name == "mixing":
            taken = {(r["doc_id"], r["_key"]): r["times"] for r in sources.mix(rows_before).collect()}
            keyed = rows_before.select("doc_id", row_key(F.coalesce("text", F.lit(""))).alias("_key"), "text").collect()
            assert after == Counter({(r["doc_id"], r["text"]): n for r in keyed if (n := taken[r["doc_id"], r["_key"]])})
            check_mix([tuple(r) for r in rows_before.select("doc_id", "text", "source").collect()], sources.mix(rows_before).collect())
        else:
            check_shards(before, rows.collect())


def test_stages_take_awkward_and_empty_tables(spark, awkward, nothing):
    given = Counter(tuple(r) for r in awkward.collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF_DIR).collect() == []
        got = stage(spark, awkward, SF_DIR)
        if name == "sharding":
            assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in given.elements())
            continue
        assert got.columns == awkward.columns
        left = Counter(tuple(r) for r in got.collect())
        # Rows come as they are, other columns included; only the mix repeats them.
        assert set(left) <= set(given) and (name == "mixing" or all(n <= given[r] for r, n in left.items()))
        blank = Counter({r: n for r, n in given.items() if not (r[1] or "").split()})
        if name != "mixing":
            assert Counter({r: n for r, n in left.items() if not (r[1] or "").split()}) == blank


def test_near_dedup_removes_single_rows_of_repeated_and_missing_ids(spark):
    say = lambda word: " ".join(f"{word}{k}" for k in range(60))
    a, b = say("a"), say("b")
    near = b.replace("b30", "other")
    stay = [(3, b), (7, a), (None, say("c")), (None, say("d")), (None, None), (8, say("e")), (8, say("e")), (None, "")]
    gone = [(7, b), (None, near), (None, b), (8, near)]
    docs = spark.createDataFrame(stay + gone, "doc_id long, text string").repartition(3)
    left = Counter(tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect())
    assert left == Counter(stay)
