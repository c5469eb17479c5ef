"""SimHash fingerprints and Hamming-radius search, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.storage import stored

BITS = 128
RADIUS = 3
#: Radius of the wide search, and its blocks: within it one of the six differs in at most one bit.
WIDE = 11
WIDE_BLOCKS = ((0, 22), (22, 22), (44, 21), (65, 21), (86, 21), (107, 21))
#: Bits per block; two of the five stay equal within the radius, so ten tables find every match.
BLOCKS = ((0, 26), (26, 26), (52, 26), (78, 25), (103, 25))
WEIGHT = 9
SPACES = r"[\x20\x09-\x0D]+"
HALF = 1 << 32
ROWS_PER_RANGE = 256
MOST_RANGES = 1 << 16


def _votes(term: str) -> list[Column]:
    """Weighted votes of a term for the 128 bits, two 32-bit counters to a long.

    A word counts by its letters beyond two, at most nine, so that short common words hardly
    matter.  A string has fewer than 2**31 bytes, so that no counter overflows.
    """
    weight = F.greatest(F.lit(1), F.least(F.lit(WEIGHT), F.length(term) - 2)).cast("long")
    out = []
    for half in (0, 1):
        hashed = F.xxhash64(F.lit(half), term)
        for k in range(32):
            # Bit k moves to the lower counter and bit k + 32 to the upper one.
            pair = F.shiftrightunsigned(hashed, k).bitwiseAND(F.lit(HALF + 1))
            out.append((pair * F.col("_weight")).alias(f"_v{half * 32 + k}"))
    return [weight.alias("_weight"), *out]


def _bits(half: int) -> Column:
    """64 bits of the fingerprint: those for which more than half of the weight voted."""
    def bit(votes: Column, place: int) -> Column:
        return F.when(2 * votes > F.col("_total"), F.lit(1 << place if place < 63 else -(1 << 63))).otherwise(F.lit(0))

    parts = []
    for k in range(32):
        v = F.col(f"_v{half * 32 + k}")
        parts += [bit(v.bitwiseAND(F.lit(HALF - 1)), k), bit(F.shiftrightunsigned(v, 32), k + 32)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts).cast("long")


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, ``low`` and ``high``: the fingerprint of every text.

    Terms are the lower-cased runs of non-space of the whole text, each occurrence voting.  Votes add up
    where the text is, so only one row of counters per text is shuffled, if any.  A text
    without terms has an empty fingerprint of zeros.
    """
    words = F.explode(F.split(F.lower(text), SPACES))
    terms = rows.select(*keys, words.alias("_term")).where("_term <> ''")
    weight, *votes = _votes("_term")
    voted = terms.select(*keys, "_term", weight).select(*keys, "_weight", *votes)
    sums = [F.sum(f"_v{k}").alias(f"_v{k}") for k in range(64)]
    return (
        voted.groupBy(*keys)
        .agg(F.sum("_weight").alias("_total"), *sums)
        .select(*keys, _bits(0).alias("low"), _bits(1).alias("high"))
    )


def hex_of(low: str, high: str) -> Column:
    part = lambda c: F.lpad(F.lower(F.hex(F.col(c))), 16, "0")
    return F.concat(part(high), part(low))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Share of equal bits."""
    differ = sum(F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b))
    return 1 - differ / BITS


def _block(low: str, high: str, start: int, size: int) -> Column:
    """``size`` bits of the fingerprint from ``start`` on."""
    mask = F.lit((1 << size) - 1)
    if start >= 64:
        return F.shiftrightunsigned(high, start - 64).bitwiseAND(mask)
    bits = F.shiftrightunsigned(low, start)
    if start + size > 64:
        bits = bits.bitwiseOR(F.shiftleft(high, 64 - start))
    return bits.bitwiseAND(mask)


def block_tables(prints: DataFrame) -> DataFrame:
    """One row per fingerprint and table: two of its five blocks in front, as the table's key."""
    tables = [
        F.struct(F.lit(k).alias("table"), F.shiftleft(_block("low", "high", *BLOCKS[i]), 26).bitwiseOR(_block("low", "high", *BLOCKS[j])).alias("front"))
        for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]
    return prints.select("*", F.inline(F.array(*tables)))


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``low, high, near_low, near_high``: all fingerprints within ``radius`` of each query.

    Both sides hold distinct fingerprints, so copies cost one row.  A pair is reported by the
    first table that both share, hence once.  ``radius`` is at most three, one less than the
    blocks that may differ before no two of five are equal.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must lie between 0 and {RADIUS}")
    q = block_tables(queries.select("low", "high").distinct()).alias("q")
    p = block_tables(prints.select("low", "high").distinct()).alias("p")
    same = [
        _block("q.low", "q.high", *b) == _block("p.low", "p.high", *b) for b in BLOCKS
    ]
    first = F.coalesce(
        *(F.when(same[i] & same[j], F.lit(k)) for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2)))
    )
    differ = F.bit_count(F.col("q.low").bitwiseXOR(F.col("p.low"))) + F.bit_count(F.col("q.high").bitwiseXOR(F.col("p.high")))
    on = (F.col("q.table") == F.col("p.table")) & (F.col("q.front") == F.col("p.front")) & (differ <= radius) & (first == F.col("q.table"))
    return q.join(p, on).select("q.low", "q.high", F.col("p.low").alias("near_low"), F.col("p.high").alias("near_high"))


def around(queries: DataFrame, prints: DataFrame, radius: int = WIDE) -> DataFrame:
    """``low, high, near_low, near_high, differ``: all fingerprints within ``radius`` of each query.

    Every print has a row per block; every query one per block and value at most one bit away.
    A pair is reported by the first block that differs in at most one bit, hence once.
    ``radius`` is at most eleven, as twelve bits could differ twice in each of the six blocks.
    """
    if not 0 <= radius <= WIDE:
        raise ValueError(f"radius must lie between 0 and {WIDE}")

    def block_rows(rows: DataFrame, flips: bool) -> DataFrame:
        rows, tables = rows.select("low", "high").distinct(), []
        for k, (start, size) in enumerate(WIDE_BLOCKS):
            masks = [0, *(1 << bit for bit in range(size) if flips)]
            listed = F.transform(F.lit(masks).cast("array<long>"), lambda m: _block("low", "high", start, size).bitwiseXOR(m))  # noqa: B023
            tables.append(F.struct(F.lit(k).alias("table"), listed.alias("fronts")))
        rows = rows.select("low", "high", F.inline(F.array(*tables)))
        return rows.select("low", "high", "table", F.explode("fronts").alias("front"))

    q, p = block_rows(queries, True).alias("q"), block_rows(prints, False).alias("p")
    close = [F.bit_count(_block("q.low", "q.high", *b).bitwiseXOR(_block("p.low", "p.high", *b))) <= 1 for b in WIDE_BLOCKS]
    first = F.coalesce(*(F.when(c, F.lit(k)) for k, c in enumerate(close)))
    differ = F.bit_count(F.col("q.low").bitwiseXOR(F.col("p.low"))) + F.bit_count(F.col("q.high").bitwiseXOR(F.col("p.high")))
    on = (F.col("q.table") == F.col("p.table")) & (F.col("q.front") == F.col("p.front")) & (differ <= radius) & (first == F.col("q.table"))
    return q.join(p, on).select("q.low", "q.high", F.col("p.low").alias("near_low"), F.col("p.high").alias("near_high"), differ.alias("differ"))


def _tops(docs: DataFrame, key: Column) -> list[int]:
    """Greatest keys of ranges of about ``ROWS_PER_RANGE`` rows, from the highest range down.

    Only keys move, in as many tasks as any shuffle has, and only one number per range, at most
    ``MOST_RANGES`` and one per task, comes to the driver.
    """
    keys = docs.select(key.alias("k"))
    step = max(ROWS_PER_RANGE, -(-keys.count() // MOST_RANGES))
    ordered = keys.repartitionByRange(F.col("k").desc()).sortWithinPartitions(F.col("k").desc())
    # The number of a row inside its partition.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    tops = ordered.select("k", place.alias("_at")).where(F.col("_at") % step == 0).select("k").distinct()
    return sorted((r["k"] for r in tops.collect()), reverse=True)


def _range_of(key: Column, tops: Column, count: int) -> Column:
    """Index of the last range whose top isn't below the key, by binary search."""
    steps = F.lit([1 << k for k in reversed(range(max(1, (count - 1).bit_length())))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when((at + step < count) & (F.get(tops, at + step) >= key), at + step).otherwise(at),
    )


def with_edits(docs: DataFrame) -> DataFrame:
    """``doc_id, range, place, ghost, n_chars, text, edited`` with texts in descending doc_id order.

    The last floor(n / 2) code points of a text give way to the first as many, or all, of the
    next row's (NULL ids last; after the last row comes the first).  Texts are shuffled once,
    by ranges of ids; the first row of each range is also put at the end of the one before,
    as its ghost, so that no row looks beyond its range.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))
    tops = _tops(docs, key)
    if not tops:
        tops = [0]
    listed = F.lit(tops).cast("array<long>")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("_k"))
    rows = rows.withColumn("_range", _range_of(F.col("_k"), listed, len(tops)))
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("ghost"))
    before = F.struct(F.pmod(F.col("_range") - 1, F.lit(len(tops))).alias("range"), F.lit(True).alias("ghost"))
    is_top = F.get(listed, F.col("_range")) == F.col("_k")
    rows = rows.select("doc_id", "text", F.inline(F.when(is_top, F.array(own, before)).otherwise(F.array(own))))
    # Never NULL, but a later join asks for it on one side only, which would part the two uses.
    rows = rows.where(F.col("range").isNotNull())
    # By doc_id, so that both uses of these rows read the same columns and share one shuffle.
    order = Window.partitionBy("range").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    rows = rows.select(
        "doc_id", "range", "ghost", "text", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("_next")
    )
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    changed = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    return rows.select("doc_id", "range", "place", "ghost", n.cast("long").alias("n_chars"), "text", changed.alias("edited"))


def likenesses(docs: DataFrame, every: int = 100, radius: int = RADIUS, wide: int = WIDE) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_near, n_copies, copies`` for every row.

    ``near_edited`` and ``near_next`` are the shares of bits equal to those of the row's
    edited text (:func:`with_edits`) and of the next row.  ``n_near`` counts the other rows
    whose fingerprint lies within ``radius``, ``n_copies`` those within ``wide``, and ``copies``
    lists the distinct fingerprints of the latter, the row's own if another row has it, in
    order; the rows that have them are the found documents.  The three are searched for rows
    whose doc_id is divisible by ``every`` and NULL for others.  NULL text is empty; texts without words have
    a fingerprint of zeros; equal texts have equal fingerprints; repeated rows are rows of
    their own; an empty table gives no rows; other columns are ignored.
    """
    rows = with_edits(docs)
    keys = ["range", "place"]
    both = rows.select(*keys, F.inline(F.array(
        F.struct(F.lit(0).alias("form"), F.col("text").alias("_text")),
        F.struct(F.lit(1).alias("form"), F.col("edited").alias("_text")),
    )))
    prints = fingerprints(both, [*keys, "form"], "_text").groupBy(*keys).agg(
        *(F.max(F.when(F.col("form") == k, F.col(c))).alias(c + str(k)) for k in (0, 1) for c in ("low", "high"))
    )
    about = rows.select(*keys, "doc_id", "ghost", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("low0", "high0", "low1", "high1")]
    found = stored(about.join(prints, keys, "left").select(*about.columns, *zero))
    following = Window.partitionBy("range").orderBy("place")
    found = found.select("*", F.lead("low0").over(following).alias("_low"), F.lead("high0").over(following).alias("_high")).where("not ghost")
    asked = F.col("doc_id") % every == 0
    near = _near(found.select("low0", "high0", asked.alias("asked")), radius, wide)
    joined = found.join(near, (found.low0 == near.low) & (found.high0 == near.high) & asked, "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_of("low0", "high0").alias("fingerprint"),
        hex_of("low1", "high1").alias("edited_fingerprint"),
        likeness(("low0", "high0"), ("low1", "high1")).alias("near_edited"),
        likeness(("low0", "high0"), ("_low", "_high")).alias("near_next"),
        "n_near",
        "n_copies",
        "copies",
    )


def _near(rows: DataFrame, radius: int, wide: int) -> DataFrame:
    """``low, high, n_near, n_copies, copies`` for the fingerprints of asked rows."""
    known = rows.groupBy(F.col("low0").alias("low"), F.col("high0").alias("high")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("asked").alias("_asked")
    )
    pairs = around(known.where("_asked"), known, max(radius, wide))
    counts = known.select(F.col("low").alias("near_low"), F.col("high").alias("near_high"), "_rows")
    near, copy = F.col("differ") <= radius, F.col("differ") <= wide
    listed = F.when(copy & ((F.col("differ") > 0) | (F.col("_rows") > 1)), hex_of("near_low", "near_high"))
    return pairs.join(counts, ["near_low", "near_high"]).groupBy("low", "high").agg(
        (F.sum(F.when(near, F.col("_rows"))) - 1).alias("n_near"),
        (F.sum(F.when(copy, F.col("_rows"))) - 1).alias("n_copies"),
        F.sort_array(F.collect_list(listed)).alias("copies"),
    )
