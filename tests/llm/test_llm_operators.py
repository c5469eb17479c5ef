"""Every operator against a brute-force version, over given and awkward tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
from awkward_tables import SF_DIR, awkward_rows, words_of
from scrubline.llm import chat, decontamination, exact_dedup, licenses, mixing, near_dedup, ranked_search, sharding, simhash, token_counts, token_store, toxicity, vector_codes
from scrubline.llm.components import components
from scrubline.llm.storage import passing, placed, scratch, stored, without

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


# helpers


def test_placed_numbers_all_rows(spark):
    got = placed(spark.range(1000).select((F.col("id") % 7).alias("k"), "id"), F.col("k"), F.col("id")).collect()
    assert [r["pos"] for r in sorted(got, key=lambda r: (r["k"], r["id"]))] == list(range(1000))


def test_components_of_chain_and_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (3, 4)]
    got = {(r["id"], r["component"]) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(41)} | {(k, 100) for k in range(100, 130)}


def test_without_drops_exactly(spark):
    rows = spark.createDataFrame([(k if k % 10 else None, str(k)) for k in range(100)], "a long, b string")
    gone = spark.createDataFrame([(None,), (5,), (5,), (999,)], "a long")
    left = [r["a"] for r in without(rows, gone, ["a"]).collect()]
    assert sorted(left) == [k for k in range(100) if k % 10 and k != 5]


# 1: license scans


def test_patience_alignment():
    notice = "a b c d e f g".split()
    assert licenses.align("x a b q c d e f g y".split(), notice) == [(1, 0), (2, 1), (4, 2), (5, 3), (6, 4), (7, 5), (8, 6)]
    assert licenses.align([], notice) == [] == licenses.align(notice, [])
    assert len(licenses.align("d e f a b c g".split(), notice)) == 4
    assert licenses._increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])


def test_license_scan_finds_changed_and_repeated_notices(spark):
    mit, gpl = licenses.NOTICES["MIT-text"], licenses.NOTICES["GPL-3.0-header"]
    changed = mit.replace("free of charge", "at no charge").upper()
    rng = np.random.default_rng(1)
    stray = " ".join(f"{w} q{rng.integers(10**6)}" for w in mit.split())
    rows = [(1, f"start {mit} end"), (2, f"{changed}\n\n{changed}"), (3, "Licensed under CC BY-NC 4.0. " * 3), (4, "nothing"), (5, None)]
    rows += [(6, mit[: len(mit) // 2]), (None, licenses.NOTICES["GPL-3.0"])]
    rows += [(7, mit.replace("deal in the Software", "deal in the Software (free of charge)")), (8, f"{stray} {mit}")]
    rows += [(9, gpl.replace("version 3", "version 2")), (10, gpl), (11, gpl.replace("General", "Affero General")), (12, gpl.replace("Public", "xx"))]
    rows += [(13, licenses.NOTICES["BSD-2-Clause-text"]), (14, licenses.NOTICES["BSD-3-Clause-text"]), (15, f"{mit} {gpl} {mit}")]
    rows += [(16, "the software is provided and the permission of this copy to any of the " * 40)]
    got = by_id(licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert (got[1].licenses, got[1].coverage, got[1].n_found) == ("MIT-text", 1.0, 1)
    assert got[1].found[0]["first"] == 1 and got[1].found[0]["last"] == got[1].n_words - 2
    assert got[2].n_found == 2 and 0.9 < got[2].coverage < 1
    assert (got[3].licenses, got[3].n_found) == ("CC-BY-NC-4.0", 3)
    assert [got[k].n_found for k in (4, 5, 6, 16)] == [0] * 4
    assert got[None].licenses == "GPL-3.0"
    assert (got[7].licenses, got[7].coverage) == ("MIT-text", 1.0)
    assert (got[8].licenses, got[8].n_found) == ("MIT-text", 2)
    names = {9: "GPL-2.0-header", 10: "GPL-3.0-header", 11: "AGPL-3.0-header", 12: "GPL-3.0-header", 13: "BSD-2-Clause-text", 14: "BSD-3-Clause-text"}
    assert {k: got[k].licenses for k in names} == names
    assert [f["license"] for f in got[15].found] == ["MIT-text", "GPL-3.0-header", "MIT-text"]
    assert licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), {"none": "...", "one": "nothing"}).where("n_found > 0").count() == 1


def test_license_coverage_is_that_of_full_alignment(spark, documents):
    """Every window of a text of every width that an occurrence may have, aligned in full."""
    notices = {n: t for n, t in licenses.NOTICES.items() if len(t) < 120}
    plain = {n: words_of(t, SIGN) for n, t in notices.items()}
    rng = np.random.default_rng(2)
    rows = [(r.doc_id, r.text) for r in documents if len(r.text or "") < 4000]
    for k, (name, text) in enumerate(notices.items()):
        w = text.split()
        w.insert(len(w) // 2, w[1])
        rows.append((10**6 + k, f"some words {' '.join(w)} and the license of this work {' '.join(w[::-1])}"))
    got = by_id(licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), notices))
    assert sum(g.n_found > 0 for g in got.values()) >= 6
    for doc_id, text in rows:
        words = words_of(text, SIGN)
        best = {}
        for name, notice in plain.items():
            for stretch in licenses.STRETCH:
                size = max(math.ceil(stretch * len(notice)), len(notice) + 1)
                for at in range(len(words)):
                    part = words[at : at + size]
                    if sum(w in notice for w in part) >= 0.8 * len(notice):
                        best[name] = max(best.get(name, 0), len(licenses.align(part, notice)) / len(notice))
        want = max((c for c in best.values() if c >= 0.8), default=0.0)
        assert (got[doc_id].coverage > 0) == (want > 0) and got[doc_id].coverage >= want - 0.2


SIGN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def test_license_scan_matches_plain_search(spark, documents):
    got = by_id(driver.queries()["op1_license_scan"](spark, SF_DIR))
    short = {n: words_of(t, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+") for n, t in licenses.NOTICES.items()}
    for row in documents:
        words = words_of(row.text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        exact = {n for n, t in short.items() if any(words[k : k + len(t)] == t for k in range(len(words) - len(t) + 1))}
        assert exact <= set(got[row.doc_id].licenses.split(",")) and (exact or not got[row.doc_id].n_found)


# 2: fingerprints


def likeness(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def check_prints(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    assert len(got) == len(rows)
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)]
        half = len(text) // 2
        changed = text[: len(text) - half] + (following[1] or "")[:half]
        row = got[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.near_edited == pytest.approx(likeness(row.fingerprint, row.edited_fingerprint))
        assert row.near_next == pytest.approx(likeness(row.fingerprint, got[following[0]].fingerprint))
        if doc_id is not None and doc_id % 100 == 0:
            near = sum(likeness(row.fingerprint, g.fingerprint) >= 1 - 3 / 128 for g in got.values())
            assert row.n_near == near - 1
        else:
            assert row.n_near is None


def test_simhash_query(spark, documents):
    got = by_id(driver.queries()["op2_simhash"](spark, SF_DIR))
    check_prints([(r.doc_id, r.text) for r in documents], got)
    by_text = {}
    for r in documents:
        assert by_text.setdefault(r.text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint
    assert np.mean([g.near_edited > g.near_next for g in got.values()]) > 0.95


def test_simhash_awkward(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS_PER_RANGE", 7)
    once = {r[0]: r[:2] for r in awkward_rows()}
    docs = awkward.dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(rows) == len(once)
    check_prints(rows, by_id(simhash.likenesses(docs)))
    assert simhash.likenesses(awkward).count() == len(awkward_rows())
    assert simhash.likenesses(nothing).count() == 0


def test_fingerprints_are_the_votes_of_their_terms(spark, documents):
    """Vote by vote, by another implementation of the hash."""
    import struct

    import xxhash

    rows = [(k, r.text) for k, r in enumerate(documents[:40])] + [(100, "a"), (101, "bb  bb cc\tdddddddddddddddd"), (102, "")]
    got = {r.doc_id: (r.low, r.high) for r in simhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], "text").collect()}
    for doc_id, text in rows:
        terms = [t for t in re.split(simhash.SPACES, text.lower()) if t]
        if not terms:
            assert doc_id not in got
            continue
        weight = [max(1, min(simhash.WEIGHT, len(t) - 2)) for t in terms]
        for half in (0, 1):
            seed = xxhash.xxh64_intdigest(struct.pack("<i", half), seed=42)
            hashed = [xxhash.xxh64_intdigest(t.encode(), seed=seed) for t in terms]
            bits = sum(1 << b for b in range(64) if 2 * sum(w for w, h in zip(weight, hashed) if h >> b & 1) > sum(weight))
            assert got[doc_id][half] % 2**64 == bits


def test_radius_search_is_whole(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, (20, 2))
    prints = {tuple(map(int, b)) for b in base}
    for low, high in base:
        for flips in (1, 2, 3, 4):
            value = int(low) % 2**64 | (int(high) % 2**64) << 64
            for bit in rng.choice(128, flips, replace=False):
                value ^= 1 << int(bit)
            signed = [v - 2**64 if v >= 2**63 else v for v in (value % 2**64, value >> 64)]
            prints.add(tuple(signed))
    frame = spark.createDataFrame(sorted(prints), "low long, high long")
    for radius in (0, 2, 3):
        got = {tuple(r) for r in simhash.within(frame, frame, radius).collect()}
        apart = lambda p, q: sum((x % 2**64 ^ y % 2**64).bit_count() for x, y in zip(p, q))
        assert got == {(*p, *q) for p in prints for q in prints if apart(p, q) <= radius}
    assert simhash.within(frame, frame, 3).count() == len({tuple(r) for r in simhash.within(frame, frame, 3).collect()})
    with pytest.raises(ValueError):
        simhash.within(frame, frame, 4)


def test_wide_search_is_whole(spark):
    rng = np.random.default_rng(6)
    prints = set()
    for _ in range(20):
        base = int.from_bytes(rng.bytes(16), "little")
        for flips in range(14):
            value = base
            for bit in rng.choice(128, flips, replace=False):
                value ^= 1 << int(bit)
            prints.add(tuple(v - 2**64 if v >= 2**63 else v for v in (value % 2**64, value >> 64)))
        # Two bits in five of the blocks, one in the last.
        value = base ^ sum(3 << start for start, _ in simhash.WIDE_BLOCKS[:-1]) ^ 1 << 127
        prints.add(tuple(v - 2**64 if v >= 2**63 else v for v in (value % 2**64, value >> 64)))
    frame = spark.createDataFrame(sorted(prints), "low long, high long")
    apart = lambda p, q: sum((x % 2**64 ^ y % 2**64).bit_count() for x, y in zip(p, q))
    for radius in (3, 11):
        got = Counter(tuple(r) for r in simhash.around(frame, frame, radius).collect())
        assert got == Counter((*p, *q, apart(p, q)) for p in prints for q in prints if apart(p, q) <= radius)
    with pytest.raises(ValueError):
        simhash.around(frame, frame, 12)


def test_simhash_recalls_changed_copies(spark):
    """Copies with one changed word in fifty are listed; the found rows are named by fingerprint."""
    rng = np.random.default_rng(7)
    say = lambda: "".join(rng.choice(list("abcdefghiklmnoprstu"), rng.integers(2, 10)))
    rows = []
    for k in range(0, 4000, 100):
        words = [say() for _ in range(200)]
        rows.append((k, " ".join(words)))
        for place in rng.choice(200, 4, replace=False):
            words[place] = say()
        rows.append((k + 1, " ".join(words)))
    rows.append((5, rows[0][1]))
    got = by_id(simhash.likenesses(spark.createDataFrame(rows, "doc_id long, text string")))
    for k in range(0, 4000, 100):
        near = [d for d, g in got.items() if d != k and likeness(got[k].fingerprint, g.fingerprint) >= 1 - 11 / 128]
        assert got[k].n_copies == len(near) and got[k].copies == sorted({got[d].fingerprint for d in near})
    assert got[1].n_copies is None and got[1].copies is None and got[0].fingerprint in got[0].copies
    assert np.mean([got[k + 1].fingerprint in got[k].copies for k in range(0, 4000, 100)]) >= 0.9


# 3: near-duplicates


def brute_components(rows, similarity=75):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    low = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root(k)] = min(doc_id, low.get(root(k), doc_id))
    out = []
    for k, (doc_id, _) in enumerate(rows):
        component = low.get(root(k)) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), component, doc_id == component))
    return Counter(out)


def group_of(rng, say, n, edits, length=120):
    base = [say(rng) for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for place in rng.choice(length, edits, replace=False):
            words[place] = say(rng)
        out.append(" ".join(words))
    return out


def test_near_dedup_awkward(spark, awkward, nothing):
    got = Counter(tuple(r) for r in near_dedup.near_duplicates(awkward).collect())
    assert got == brute_components([r[:2] for r in awkward_rows()])
    assert near_dedup.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("pairs", [200, 1 << 25])
def test_near_dedup_large_nodes(spark, monkeypatch, pairs):
    """Groups of near copies and a passage shared by many, with nodes that count as large."""
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 6)
    monkeypatch.setattr(near_dedup, "PAIRS", pairs)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    monkeypatch.setattr(near_dedup, "CHUNK", 16)
    monkeypatch.setattr(near_dedup, "DEPTH", 3)
    rng = np.random.default_rng(8)
    say = lambda r: "w" + str(r.integers(0, 10**6))
    texts = group_of(rng, say, 60, 2) + group_of(rng, say, 60, 4) + group_of(rng, say, 40, 6)
    passage = " ".join(say(rng) for _ in range(60))
    texts += [passage + " " + " ".join(say(rng) for _ in range(n)) for n in rng.integers(10, 90, 60)]
    texts += [t for t in texts[:5]] + [" ".join(say(rng) for _ in range(50)) for _ in range(40)]
    rows = [(int(k), t) for k, t in zip(rng.permutation(len(texts)), texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in near_dedup.near_duplicates(docs).collect()) == brute_components(rows)


def test_links_inside_a_group_are_exact_and_few():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    sets = []
    for k in range(60):
        keep = rng.random(200) < (0.95 if k % 2 else 0.8)
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**63, 15, dtype=np.uint64)])))
    comp = [k if k > 4 else 0 for k in range(60)]
    found = near_dedup._links_of(sets, list(range(60)), comp, [c > 0 for c in comp], 75)

    def groups(links):
        label = list(comp)
        for a, b in links:
            old, new = label[a], label[b]
            label = [new if x == old else x for x in label]
        return {frozenset(k for k in range(60) if label[k] == x) for x in set(label)}

    every = [
        (a, b) for a, b in combinations(range(60), 2)
        if 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= 75 * (len(sets[a]) + len(sets[b]) - both)
    ]
    assert set(found) <= set(every) and groups(found) == groups(every) and len(found) < 60 < len(every)


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    seen = []
    plain = near_dedup.confirm

    def counted(pairs, groups, reps, docs, similarity):
        seen.append(pairs.count())
        return plain(pairs, groups, reps, docs, similarity)

    monkeypatch.setattr(near_dedup, "confirm", counted)
    say = lambda word: " ".join(f"{word}{k}" for k in range(60))
    near = say("a").replace("a30", "other")
    docs = spark.createDataFrame([(1, say("a"))] * 80 + [(2, near)] * 80, "doc_id long, text string").repartition(4)
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()} == {(1, 1), (2, 1)}
    assert max(seen) == 1


def test_handed_over_tables_go_with_their_scope(spark):
    import os

    place = lambda df: df.inputFiles()[0].rpartition("/")[0].removeprefix("file:")
    with passing(spark):
        first = place(stored(spark.range(3)))
        with passing(spark):
            kept, gone = place(stored(spark.range(3), lasting=True)), place(stored(spark.range(3)))
        assert os.path.isdir(first) and os.path.isdir(kept) and not os.path.exists(gone)
    assert not os.path.exists(first) and not os.path.exists(kept)


# 4: mixing


def test_targets_stop_and_reshare():
    from fractions import Fraction

    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]
    got = mixing.targets([10, 1000, 1000, 0, 5])
    assert got[0] == 30 and got[4] == 15 and got[3] == 0
    assert sum(got) == 2015 and got[1] == 2 * got[2] == Fraction(2 * 1970, 3)


def test_fit_is_nearest(monkeypatch):
    rng = np.random.default_rng(5)
    for limit in (1 << 16, 40):
        monkeypatch.setattr(mixing, "EXACT_WORDS", limit)
        for _ in range(60):
            counts = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 60), 5, replace=False), rng.integers(1, 6, 5))}
            total = sum(n * c for n, c in counts.items())
            budget = int(rng.integers(0, total + 5))
            taken = mixing.fit(budget, counts)
            assert all(0 <= taken[n] <= counts[n] for n in taken)
            off = budget - sum(n * c for n, c in taken.items())
            sums = {0}
            for n, c in counts.items():
                sums = {s + n * k for s in sums for k in range(c + 1)}
            best = min(abs(budget - s) for s in sums)
            assert abs(off) == best if max(limit, 4 * max(counts)) >= budget else abs(off) <= best + max(counts) / 3


@pytest.mark.parametrize("counts, budget, nearest", [({100_000: 2}, 90_000, 100_000), ({100_000: 10}, 590_000, 600_000), ({2_000_000: 1, 10: 500}, 1_900_000, 2_000_000), ({7: 3, 10**9: 3}, 2 * 10**9 + 6, 2 * 10**9 + 7)])
def test_fit_takes_long_documents(counts, budget, nearest):
    got = sum(n * c for n, c in mixing.fit(budget, counts).items())
    # Beyond CELLS words lengths count in units.
    assert got == nearest if budget < mixing.CELLS else abs(got - budget) <= 4 * budget / mixing.CELLS


def test_mixed_rows_are_those_of_the_mix(spark):
    rows = [(1, "w " * 10, "a")] * 1000 + [(k, "x " * 7, "b") for k in range(300)] + [(None, "y " * 3, None)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).withColumn("_key", F.lit(5)).withColumn("pos", F.lit(1))
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"], r["source"]] += r["times"]
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and got.where("_key <> 5 or pos <> 1").count() == 0
    assert Counter((r["doc_id"], r["source"]) for r in got.collect()) == Counter({k: n for k, n in taken.items() if n})
    each = Counter(r["text"] for r in got.collect())
    assert each["w " * 10] == taken[1, "a"] % 10**6 and each["w " * 10] % 1000


def check_mix(rows, got):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words_of(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([sizes[s] for s in order])))
    taken = Counter()
    assert Counter((r["doc_id"], r["size"], r["source"], r["source_size"]) for r in got) == Counter(
        (d, len(words_of(t)), s, sizes[s]) for d, t, s in rows
    )
    for r in got:
        assert r["target"] == pytest.approx(float(target[r["source"]])) and r["taken"] == r["times"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in order:
        sums = {0}
        for n in [len(words_of(t)) for _, t, k in rows if k == s]:
            sums |= {n + x for x in sums}
        whole = target[s] // sizes[s] * sizes[s] if sizes[s] else 0
        assert abs(taken[s] - target[s]) <= min(abs(whole + x - target[s]) for x in sums) + 1


def test_mix(spark, awkward, nothing, documents):
    got = mixing.mix(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    check_mix([(r.doc_id, r.text, r.source) for r in documents], got)
    again = driver.queries()["op4_mixing"](spark, SF_DIR).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}
    check_mix([(r[0], r[1], r[3]) for r in awkward_rows()], mixing.mix(awkward).collect())
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed(nothing).columns == nothing.columns


# 5: chat formatting


def test_escapes_are_reversible():
    for text in ("", "<|im_end|>", "<\\|a", "<\\\\||<|", "<", "|", "\\", "<|im_start|>user<|im_sep|>x"):
        assert chat.unescape(chat.escape(text)) == text
        assert not any(m in chat.escape(text) for m in (chat.START, chat.SEPARATOR, chat.END))


def test_mask_by_binary_search():
    offsets = np.array([(0, 2), (2, 5), (5, 5), (5, 9), (9, 12), (12, 13)])
    spans = np.array([(2, 5), (9, 12)])
    brute = [any(a < f and b > e for e, f in spans) and a < b for a, b in offsets]
    assert chat.mask(offsets, spans).tolist() == brute == [False, True, False, False, True, False]


def brute_chats(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        chars = sum(32 + len(chat.escape(role)) + len(chat.escape(t)) for _, role, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def test_chats_awkward(spark, monkeypatch):
    odd = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", " \n\n é中\U0001f600\U0001f600 ß "), (1, 2, "assistant", None), (1, 3, None, odd)]
    rows += [(2, None, "assistant", odd * 3), (2, 0, "assistant", "<"), (2, 0, "assistant", "<"), (None, 1, "a\nb|<|", ""), (3, 0, "assistant", "")]
    rows += [(4, k, ("user", "assistant")[k % 2], f"turn {k} <|im_sep|> " + "long " * 50) for k in range(80)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("piece", F.lit(9)).repartition(3)
    for size in (1 << 22, 1000):
        monkeypatch.setattr(chat, "PIECE_CHARS", size)
        formatted = chat.format_chats(frame, BYTES, scratch(spark))
        assert {r[0]: tuple(r)[1:] for r in chat.read_back(formatted).collect()} == brute_chats(rows)
    ids = {r["conv_id"]: r for r in formatted.collect()}
    library = chat.chat_tokenizer(BYTES)
    encoded = library.encode(ids[1]["text"], add_special_tokens=False)
    assert np.frombuffer(ids[1]["ids"], "<i4").tolist() == encoded.ids
    assert chat.offsets_of(ids[1]["gaps"], ids[1]["lengths"]).tolist() == [list(o) for o in encoded.offsets]
    assert chat.runs(np.array([1, 1, 0, 1, 0, 0, 1], bool)).tolist() == [0, 2, 3, 4, 6, 7] and not len(chat.runs(np.zeros(0, bool)))
    empty = frame.limit(0)
    assert chat.read_back(chat.format_chats(empty, BYTES, scratch(spark))).count() == 0


# 6: decontamination


def signs(text):
    return words_of(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(rows, items):
    out = []
    for doc_id, text in rows:
        words, hit, found = signs(text), set(), set()
        for item, said in items:
            test = signs(said)
            if item is None or not test:
                continue
            size = min(13, len(test))
            runs = {tuple(test[k : k + size]) for k in range(len(test) - size + 1)}
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in runs:
                    hit |= set(range(k, k + size))
                    found.add(str(item))
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), listed, bool(hit) and 20 * len(hit) >= len(words)))
    return Counter(out)


def test_contamination_awkward(spark, awkward, nothing, monkeypatch):
    rows = [r[:2] for r in awkward_rows()]
    by = {r[0]: r[1] for r in rows}
    cut = by[10].split()
    items = [(1, " ".join(cut[5000:5040])), (2, "Two-words"), (3, ""), (4, None), (None, by[6]), (5, by[6].upper()), (6, "zzzz not there")]
    items += [(7, "word"), (8, "é中"), (9, " ".join(cut[100:113])), (10, " ".join(cut[100:112])), (10, "x" * 200_000), (11, "a a a a")]
    test = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1))
    got = Counter(tuple(r) for r in decontamination.contamination(awkward, test).drop("_key").collect())
    assert got == brute_hits(rows, items)
    monkeypatch.setattr(decontamination, "TERMS_PER_PASS", 100)
    blocks = Counter(tuple(r) for r in decontamination.contamination(awkward, test).drop("_key").collect())
    assert blocks == got
    assert decontamination.contamination(nothing, test).count() == 0
    none = decontamination.contamination(awkward, test.limit(0))
    assert none.count() == len(rows) and none.where("n_hit > 0").count() == 0


def test_proximity(spark):
    item = "alpha beta gamma delta"
    rows = [(1, "x alpha beta gamma delta y"), (2, "alpha beta so gamma delta"), (3, "alpha one two three beta gamma delta"), (4, "gamma delta")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    test = spark.createDataFrame([("i", item)], "item_id string, text string")
    found = {r["doc_id"] for r in decontamination.proximity(docs, test, slack=1).collect()}
    assert found == {1, 2}
    assert {r["doc_id"] for r in decontamination.proximity(docs, test, slack=0).collect()} == {1}


# 7: token counts


def test_token_counts_and_cache(spark, awkward, nothing):
    library = Tokenizer.from_file(BYTES)
    rows = [r[:2] for r in awkward_rows()]
    n = {t: len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows}
    expected = Counter((d, len((t or "").encode()), n[t], n[t] > 512) for d, t in rows)
    cache = scratch(spark)
    assert Counter(tuple(r) for r in token_counts.token_counts(awkward, BYTES, cache).collect()) == expected
    stored = lambda: spark.read.parquet(cache).count()
    assert stored() == len({t or "" for _, t in rows})
    assert Counter(tuple(r) for r in token_counts.token_counts(awkward, BYTES, cache).collect()) == expected
    assert stored() == len({t or "" for _, t in rows})
    token_counts.token_counts(awkward, WORDS, cache).collect()
    assert stored() == 2 * len({t or "" for _, t in rows})
    assert token_counts.token_counts(nothing, BYTES).count() == 0


# 8: sharding


def check_shards(rows, got, shards=16):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    counts = Counter(r["shard"] for r in got)
    loads = [counts[s] for s in range(shards)]
    assert max(loads) - min(loads) <= 1 and sum(loads) == len(rows)
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(loads[s]))


def test_sharding(spark, awkward, nothing, documents):
    got = driver.queries()["op8_sharding"](spark, SF_DIR).collect()
    check_shards([(r.doc_id, r.text) for r in documents], got)
    check_shards([r[:2] for r in awkward_rows()], sharding.shards_of(awkward).collect())
    assert sharding.shards_of(nothing).count() == 0
    same = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"))
    check_shards([(k, "one text") for k in range(1000)], sharding.shards_of(same, 7).collect(), 7)


def test_segments_place_every_row_in_order():
    rng = np.random.default_rng(1)
    _, owners = sharding.ring(5, 8)
    for _ in range(50):
        loads = [int(n) for n in rng.integers(0, 30, len(owners)) * (rng.random(len(owners)) < 0.3)]
        cut = sharding.segments(loads, owners, 5)
        assert sum(c[1] for c in cut) == sum(loads)
        assert all(a[0] + a[1] == b[0] for a, b in zip(cut, cut[1:]))


def test_rows_go_where_the_ring_puts_them(spark, documents):
    """Row by row: the next virtual node clockwise, and on from full shards."""
    from bisect import bisect_left

    import xxhash

    shards, rows = 7, [(r.doc_id, r.text or "") for r in documents] + [(10**6 + k, "hot") for k in range(150)]
    got = {r["doc_id"]: r["shard"] for r in sharding.shards_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shards).collect()}
    places, owners = sharding.ring(shards)
    places, owners = [*places, 2**63 - 1], [*owners, owners[0]]
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    at_node = [[] for _ in places]
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), seed=42)) - (h >> 63 << 64)
    for place, doc_id in sorted((signed(t), i) for i, t in rows):
        at_node[bisect_left(places, place)].append(doc_id)
    want, over = {}, []
    for node, mine in enumerate(at_node):
        stay = min(len(mine), room[owners[node]])
        room[owners[node]] -= stay
        want |= dict.fromkeys(mine[:stay], owners[node])
        over.append(mine[stay:])
    walking = []
    for step in range(2 * len(places)):
        node = step % len(places)
        while walking and room[owners[node]]:
            room[owners[node]] -= 1
            want[walking.pop(0)] = owners[node]
        if step < len(places):
            walking += over[node]
    assert got == want and any(over)


def test_one_more_shard_moves_little(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r["doc_id"]: r["shard"] for r in sharding.shards_of(docs, 8).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.shards_of(docs, 9).collect()}
    assert sum(before[k] != after[k] for k in before) < 0.35 * len(before)


# 9: toxicity


def padded(text):
    signs = np.concatenate([toxicity.codes(text), np.zeros(toxicity.WINDOW + toxicity.SPREAD, np.int32)])
    return signs[: toxicity.WINDOW + toxicity.SPREAD]


def spread_out(signs):
    """Every gapped subsequence that begins in the window, with its weight, one by one."""
    found = Counter()
    for a in range(toxicity.WINDOW):
        for rest in combinations(range(a + 1, a + toxicity.SPREAD), toxicity.LENGTH - 1):
            found[tuple(int(signs[k]) for k in (a, *rest))] += toxicity.DECAY ** (rest[-1] - a + 1 - toxicity.LENGTH)
    return found


def test_kernel_is_the_gapped_subsequence_kernel():
    words = ["you idiot no", "you id iot no", "you id*iot no", "the station at", "a", "", "aaaaaaaaaaaaaaaaaa", "ÉTÉ 12 的话!"]
    windows = np.stack([padded(w) for w in words]).astype(np.uint8)
    brute = [spread_out(w) for w in windows]
    got = toxicity.kernel(windows, windows)
    assert got == pytest.approx(np.array([[sum(v * y[k] for k, v in x.items()) for y in brute] for x in brute]), rel=1e-4)
    assert got[0, 1] > 3 * got[0, 3] and got[0, 2] > 3 * got[0, 3]
    assert toxicity.codes("Éé\t 9a!").tolist() == [5, 5, 0, 0, 27, 1, 28]


def test_trained_weights_are_the_machines_function():
    """The weight of a window's subsequences is the sum of its kernels with the landmarks."""
    rng = np.random.default_rng(4)
    say = lambda: "".join(rng.choice(list("abcdefgh "), 14))
    toxic = np.stack([padded(f"{say()[:3]}idiot{say()}") for _ in range(60)]).astype(np.uint8)
    clean = np.stack([padded(say() + say()) for _ in range(90)]).astype(np.uint8)
    weight, bias = toxicity.fit(toxic, clean, 40)
    by_hand = [sum(v * weight[((k[0] * 32 + k[1]) * 32 + k[2]) * 32 + k[3]] for k, v in spread_out(w).items()) + bias for w in (*toxic[:5], *clean[:5])]
    assert min(by_hand[:5]) > 0 > max(by_hand[5:])
    text = "".join("abcdefgh "[k] for k in rng.integers(0, 9, 400)) + " idiot"
    scores = toxicity.window_scores(np.concatenate([toxicity.codes(text), np.zeros(16, np.int32)]), weight)
    signs = np.concatenate([toxicity.codes(text), np.zeros(32, np.int32)])
    for at in (0, 7, 250, len(text) - 1):
        want = sum(v * weight[((k[0] * 32 + k[1]) * 32 + k[2]) * 32 + k[3]] for k, v in spread_out(signs[at : at + 16]).items())
        assert scores[at] == pytest.approx(want, abs=1e-4)


def test_top_windows_are_those_of_each_text(monkeypatch):
    rng = np.random.default_rng(9)
    weight = rng.normal(size=toxicity.CODES).astype(np.float32)
    batch = ["".join(rng.choice(list("abcdé 1!"), n)) for n in (0, 1, 5, 40, 333, 0, 2000, 12)]

    def brute(text):
        signs = np.concatenate([toxicity.codes(text), np.zeros(40, np.int32)])
        scores = toxicity.window_scores(signs, weight)[: len(text)]
        out = []
        for at in np.argsort(-scores, kind="stable"):
            if len(out) < 2 and all(abs(at - k) >= toxicity.WINDOW for k, _ in out):
                out.append((at, float(scores[at])))
        return [s for _, s in out]

    want = [brute(t) for t in batch]
    got = lambda: [[s for s, _ in own] for own in toxicity.top_windows(batch, weight, 2)]
    assert got() == want
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert [own[:1] for own in got()] == [own[:1] for own in want]


INSULTS = ("trash", "pathetic", "idiot", "worthless", "disgusting", "stupid", "clown", "loser", "scum", "moron")


def test_toxicity_held_out(spark):
    """Also where a space or a sign is put into every insult of the held-out texts."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    known = labels.select("doc_id", "toxic")

    def rates(text):
        scored = toxicity.toxicity(docs.withColumn("text", F.when(toxicity.held_out(), text).otherwise(F.col("text"))), labels)
        rows = scored.join(known, "doc_id").where("held_out").collect()
        assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
        hit = sum(r["predicted"] and r["toxic"] for r in rows)
        return hit / sum(r["toxic"] for r in rows), hit / sum(r["predicted"] for r in rows)

    def broken(sign):
        text = F.col("text")
        for word in INSULTS:
            text = F.regexp_replace(text, f"(?i){word}", f"{word[: len(word) // 2]}{sign}{word[len(word) // 2 :]}")
        return text

    for text in (F.col("text"), broken(" "), broken("*")):
        recall, precision = rates(text)
        assert recall >= 0.85 and precision >= 0.9


def test_toxicity_awkward(spark, awkward, nothing):
    ids = [r[0] for r in awkward_rows() if r[0] is not None]
    marks = [(k, int(k % 3 == 0), 1) for k in ids] + [(None, 1, 1), (6, None, 1), (999, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    for some in (labels, labels.where("toxic = 1"), labels.limit(0)):
        rows = toxicity.toxicity(awkward, some).collect()
        assert len(rows) == len(awkward_rows())
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert toxicity.toxicity(nothing, labels).count() == 0
    assert toxicity.without_toxic(awkward, labels).columns == awkward.columns


# 10: token store


def check_store(rows, got):
    library = Tokenizer.from_file(WORDS)
    start, expected = 0, Counter()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        expected[doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert Counter(tuple(r) for r in got) == expected


def test_token_store(spark, awkward, nothing, documents):
    got = driver.queries()["op10_token_store"](spark, SF_DIR).collect()
    check_store([(r.doc_id, r.text) for r in documents], got)
    payload, index = token_store.token_store(nothing, WORDS, 1, scratch(spark))
    assert token_store.read_back(payload, token_store.look_up(index, token_store.keys_of(payload))).count() == 0
    folder = scratch(spark)
    token_store.token_store(awkward, WORDS, 1, folder)
    payload, index = token_store.open_store(spark, folder)
    back = token_store.read_back(payload, token_store.look_up(index, token_store.keys_of(payload))).collect()
    rows = awkward_rows()
    once = [r for r in rows if sum(x[0] == r[0] for x in rows) == 1]
    library = Tokenizer.from_file(WORDS)
    assert len(back) == len(rows)
    assert {r["doc_id"]: r["n_tokens"] for r in back if r["doc_id"] in {o[0] for o in once}} == {
        o[0]: len(library.encode(o[1] or "", add_special_tokens=False).ids) + 1 for o in once
    }
    asked = [(10, 0), (11, 0), (None, 1), (13, 0), (13, 1), (0, 0), (10**9, 0), (13, 7)]
    got = {(r.doc_id, r.copy): r.ids for r in token_store.fetch(payload, index, asked).collect()}
    whole = lambda text: library.encode(text or "", add_special_tokens=False).ids + [1]
    assert {k: got[k] for k in ((10, 0), (11, 0), (0, 0))} == {(r[0], 0): whole(r[1]) for r in rows if r[0] in (10, 11, 0)}
    of = lambda i: sorted(whole(r[1]) for r in rows if r[0] == i)
    assert sorted([got[13, 0], got[13, 1]]) == of(13) and got[None, 1] in of(None) and len(got) == 6
    assert token_store.fetch(payload, index, [(10**9, 0)]).count() == 0
    strangers = spark.createDataFrame([(10**9 + k, 0) for k in range(500)], "doc_id long, copy int")
    assert token_store.look_up(index, strangers).count() == 0


def test_a_few_keys_read_a_few_files(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), "id").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        payload, index = token_store.token_store(docs.repartition(8), WORDS, 1, scratch(spark))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert payload.select("shard").distinct().count() > 4
    found = token_store.fetch(payload, index, [(5, 0), (6, 0)])
    assert {r.doc_id for r in found.collect()} == {5, 6}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [shard" in plan
    (scan,) = [x for x in plan_metrics(found) if x]
    assert scan["numPartitions"] == 1 and scan["numFiles"] < payload.select("shard").distinct().count()
    with pytest.raises(ValueError):
        token_store.fetch(payload, index, [(k, 0) for k in range(token_store.MOST_KEYS + 1)])


def plan_metrics(frame):
    """Files and folders read by the scans of a plan that has run."""
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    out = []
    for k in range(leaves.size()):
        metrics = leaves.apply(k).metrics()
        names = ("numFiles", "numPartitions")
        out.append({n: metrics.apply(n).value() for n in names if metrics.contains(n)})
    return out


def test_perfect_hash_is_minimal(spark):
    import pandas as pd

    ids, copies = pd.Series(range(5000)) * 977 - 10**6, pd.Series([0, 1] * 2500)
    ids.iloc[0] = None
    levels, slots = token_store._levels(ids, copies)
    assert sorted(slots) == list(range(5000))
    assert token_store._slots(levels, ids, copies).tolist() == slots.tolist()


# 11: exact dedup


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_groups(rows, got):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(plain(text), []).append(doc_id)
    expected, kept = Counter(), Counter()
    for text, ids in groups.items():
        low = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept[digest, low] += 1
        for doc_id in ids:
            expected[doc_id, low, len(ids), digest] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expected
    assert Counter((r["text_sha256"], r["doc_id"]) for r in got if r["kept"]) == kept


@pytest.mark.parametrize("bits", [64, 12])
def test_exact_dedup(spark, awkward, nothing, documents, bits):
    rows = [(r["doc_id"], r["text"]) for r in documents]
    check_groups(rows, exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bits).collect())
    check_groups([r[:2] for r in awkward_rows()], exact_dedup.exact_duplicates(awkward, bits).collect())
    assert exact_dedup.exact_duplicates(nothing, bits).collect() == []


def test_chunks_share_passages_and_give_the_text_back(spark):
    rng = np.random.default_rng(5)
    say = lambda n: " ".join("w%d" % k for k in rng.integers(0, 5000, n))
    passage = say(2000)
    rows = [(0, passage), (1, f"{say(301)} {passage}"), (2, "x" * 5000), (3, ""), (4, " \n "), (5, "word " * 5000), (6, passage.replace(" ", "\n\t"))]
    parts = exact_dedup.recipes(spark.createDataFrame(rows, "doc_id long, text string"))
    found = by_id(parts)
    assert all("".join(found[k]["chunks"]) == plain(t) for k, t in rows)
    assert found[0]["ids"] == found[6]["ids"] and found[3]["ids"] == [] != found[4]["ids"]
    assert len(set(found[0]["ids"]) & set(found[1]["ids"])) >= len(found[0]["ids"]) - 2 > 8
    store = exact_dedup.chunk_store(parts).collect()
    assert sum(r["uses"] for r in store) == sum(len(r["ids"]) for r in found.values())
    assert max(r["uses"] for r in store) > 15 and len({r["chunk"] for r in store}) == len(store)


def test_recipes_of_colliding_chunks_stay_apart(spark):
    rows = [(k, f"text number {k % 40}") for k in range(120)]
    parts = exact_dedup.recipes(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    assert len({tuple(r["ids"]) for r in parts.collect()}) <= 8
    assert len({(tuple(r["ids"]), r["fixes"]) for r in parts.collect()}) == 40


def test_exact_dedup_runs_no_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 12: ranked search


def brute_search(rows, items, best=10):
    terms = [(i, re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))) for i, t in rows]
    terms = [(i, Counter(t), len(t)) for i, t in terms if t]
    total, length = len(terms), sum(n for *_, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = Counter()
    for item, text in set(items):
        asked = Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))
        scores = []
        for doc, tf, n in terms:
            m = 100 - 75 + 75 * n * total // length
            score = sum(
                k * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 8 * m))
                for t, k in asked.items() if t in tf
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores)[:best], 1):
            out[item, rank, doc, -score] += 1
    return out


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_ranked_search(spark, awkward, nothing, documents, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(None, items[0][1]), (None, None), (900, ""), (901, "word word WORD"), (901, "other word"), items[1], (902, items[2][1] * 3)]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("number", F.lit(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = lambda d, q: Counter(tuple(r) for r in ranked_search.ranked_search(d, q).collect())
    assert found(docs, asked) == brute_search(rows, items)
    monkeypatch.setattr(ranked_search, "TERMS_PER_PASS", 100)
    monkeypatch.setattr(ranked_search, "CELLS", 5000)
    assert found(docs, asked) == brute_search(rows, items)
    rows = [r[:2] for r in awkward_rows()]
    items = [(k, t) for k, (_, t) in enumerate(rows) if t is None or len(t) < 1000]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(awkward, asked) == brute_search(rows, items)
    assert not found(nothing, asked) and not found(awkward, asked.where("false")) and not found(nothing, nothing.withColumnRenamed("doc_id", "item_id"))


def test_shared_sets_are_summed_once():
    rng = np.random.default_rng(2)
    common = rng.choice(10**6, 30, replace=False)
    items = []
    for k in range(60):
        own = rng.choice(10**6, rng.integers(0, 8), replace=False)
        few = common[rng.random(30) < 0.8]
        items.append((k * 3, {int(t): int(rng.integers(1, 3)) if t in own else 1 + int(t) % 2 for t in {*few.tolist(), *own.tolist()}}))
    plan = ranked_search.shared_plan(items)
    value = {int(t): rng.integers(0, 1000, 4) for t in plan.terms}
    of_class = np.zeros((plan.class_of.max() + 1, 4), np.int64)
    np.add.at(of_class, plan.class_of, np.array([value[int(t)] for t in plan.terms]))
    sets = plan.partial_scores(of_class)
    for (number, times), (found, parts) in zip(items, plan.parts):
        assert number == found and (sets[parts].sum(axis=0) == sum(n * value[t] for t, n in times.items())).all()
    assert plan.additions() < 0.6 * sum(len(t) - 1 for _, t in items)
    assert ranked_search.shared_plan([]).parts == []


def test_length_weight_is_whole_beyond_64_bits():
    n = np.array([0, 5, 10**9])
    assert ranked_search.length_weight(n, 10**11, 10**13).tolist() == [25 + 75 * int(k) * 10**11 // 10**13 for k in n]


# 13: vector codes


def brute_codes(rows):
    """Every entry compared with every part, in Python integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    part = -(-max((len(r[1]) for r in rows), default=1) // 16) or 1
    top = vector_codes.largest(part)
    cut = []
    for _, vector, _ in rows:
        x = [max(-top, min(top, math.floor(256 * max(-1e300, min(1e300, c))))) for c in vector]
        x += [0] * (16 * part - len(x))
        cut.append([tuple(x[p * part : (p + 1) * part]) for p in range(16)])
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:64]
    books = [[cut[k][p] for k in first] for p in range(16)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, p: min((apart(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(2):
        new = []
        for p in range(16):
            members = {}
            for row in cut:
                members.setdefault(near(row[p], p)[1], []).append(row[p])
            new.append([tuple(sum(c) // len(c) for c in zip(*members[e])) if e in members else old for e, old in enumerate(books[p])])
        books = new
    found = [[near(row[p], p) for p in range(16)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (*_, label), error in zip(rows, errors):
        by_label[label] += error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter(
        (r[0], "".join("%02x" % e for _, e in f), error, by_label[r[2]], sha) for r, f, error in zip(rows, found, errors)
    )


VECTORS = "vec_id long, embedding array<float>, label int"


def test_vector_codes(spark):
    coded = lambda rows, kind=VECTORS: Counter(
        tuple(r) for r in vector_codes.vector_codes(spark.createDataFrame(rows, kind).repartition(3).withColumn("_n", F.lit(1))).collect()
    )
    given = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert coded(given) == brute_codes(given)
    rng = np.random.default_rng(3)
    vector = lambda n=32, scale=1.0: [float(np.float32(x)) for x in rng.normal(0, scale, n)]
    rows = [(k, vector(), k % 3 or None) for k in range(90)] + [(200 + k, [0.5] * 32, 9) for k in range(80)]
    rows += [(300, None, 1), (301, [None] * 32, 1), (302, [float("nan")] * 32, 2), (303, [float("inf")] + [0.0] * 31, 1), (304, [], 1)]
    rows += [(None, vector(), 4), (None, vector(), 4), (5, vector(), 1), (305, vector(7), 1), (306, vector(32, 1e30), 7), (-1, vector(), 1), rows[0], rows[0]]
    assert coded(rows) == brute_codes(rows)
    few = [(k, [float(k % 3)] * 16, None) for k in range(9)]
    assert coded(few, "vec_id long, embedding array<double>, label string") == brute_codes(few)
    assert coded([(1, [], 1)]) == brute_codes([(1, [], 1)])
    assert not coded([]) and not coded([(1, None, 2)])


@pytest.mark.parametrize("spread", [2, 9, 400, 10**7])
def test_orchard_finds_the_nearest_with_few_looks(spread, monkeypatch):
    rng = np.random.default_rng(spread)
    entries, points = (rng.integers(-spread, spread, (n, 4)) for n in (64, 3000))
    best, distance = vector_codes.Orchard(entries).nearest(points)
    apart = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    one = vector_codes.Orchard(entries[:1]).nearest(points)
    assert (one[0] == 0).all() and (one[1] == apart[:, 0]).all()
