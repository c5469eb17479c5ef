"""Toxicity by a subsequence-kernel support vector machine with Nystroem landmarks."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.storage import passing, stored, texts

#: Letters of a subsequence, letters it may be spread over, and the price of each one between.
LENGTH, SPREAD, DECAY = 4, 6, 0.5
#: Signs that a window's subsequences begin at.
WINDOW = 10
#: Codes of signs: space, 26 letters, digits, other signs, three of other letters.
SIGNS = 32
CODES = SIGNS**LENGTH
#: Windows of a text that count, and those learnt from at most.
TOP, LEARNT = 2, 3
#: Signs of a text that are scored at once.
PIECE = 1 << 18
FEATURES = 3
THRESHOLD = 0.5
LOWEST, HIGHEST = -3.0, 3.0
SHORT = 100


@dataclass(frozen=True)
class Settings:
    """Bounds of the training, which is the same at every size of the tables.

    ``per_class`` labelled rows of either class are learnt from: those with the smallest hash of
    their doc_id.  A quarter of them is kept for calibration.  ``clues`` subsequences open the
    search for toxic windows, each with a log likelihood ratio of ``least_gain`` at least.  In
    each of ``rounds`` the machine is trained on at most ``windows`` windows of either class and
    a changed copy of each toxic one, in the space of ``landmarks`` of them.
    """

    per_class: int = 3000
    clues: int = 4096
    least_gain: float = 8.0
    rounds: int = 4
    windows: int = 5000
    landmarks: int = 400


# --- kernel -----------------------------------------------------------------
_BETWEEN = list(combinations(range(1, SPREAD), LENGTH - 1))
_PRICE = [np.float32(DECAY ** (gap[-1] + 1 - LENGTH)) for gap in _BETWEEN]


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """Code of every sign of the first planes' scripts; accents and case don't count."""
    out = np.empty(0x3000, np.int32)
    for point in range(len(out)):
        sign = chr(point).lower()
        base = unicodedata.normalize("NFKD", sign)[:1]
        if sign.isspace() or point < 32:
            out[point] = 0
        elif "a" <= base <= "z":
            out[point] = ord(base) - 96
        elif sign.isdigit():
            out[point] = 27
        else:
            out[point] = 29 + point % 3 if sign.isalpha() else 28
    return out


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    table = _table()
    return np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 29 + points % 3).astype(np.int32)


def _subsequences(signs: np.ndarray) -> Iterator[tuple[np.ndarray, np.float32]]:
    """Codes of the subsequences that begin at each place of the last axis, kind by kind, and their weight.

    A kind is a choice of places after the first; its weight falls with what lies between, so
    that signs put into a word, a space among them, cost a little instead of breaking the match.
    The last ``SPREAD`` places begin none.
    """
    n = signs.shape[-1] - SPREAD
    for gap, price in zip(_BETWEEN, _PRICE):
        code = signs[..., :n] * SIGNS ** (LENGTH - 1)
        for power, at in enumerate(gap):
            code = code + signs[..., at : at + n] * SIGNS ** (LENGTH - 2 - power)
        yield code, price


def features(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The explicit feature map of windows (a row of ``WINDOW + SPREAD`` codes each): code and
    value of every occurrence of a subsequence."""
    found = list(_subsequences(windows.astype(np.int32)))
    value = np.concatenate([np.full(code.shape, price) for code, price in found], axis=1)
    return np.concatenate([code for code, _ in found], axis=1), value


def kernel(windows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of all windows with all landmarks."""
    code, value = features(windows)
    own, weight = features(landmarks)
    out = np.empty((len(windows), len(landmarks)), np.float32)
    table = np.zeros(CODES, np.float32)
    for k in range(len(landmarks)):
        np.add.at(table, own[k], weight[k])
        out[:, k] = (table[code] * value).sum(axis=1)
        table[own[k]] = 0
    return out


# --- scores of texts --------------------------------------------------------
def window_scores(signs: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of all subsequences that begin in the window at each place, added in one order.

    The last ``WINDOW + SPREAD - 1`` places begin no window.
    """
    places = np.zeros(len(signs) - SPREAD, np.float32)
    for code, price in _subsequences(signs):
        places += price * weight[code]
    n = len(places) - WINDOW + 1
    out = places[:n].copy()
    for k in range(1, WINDOW):
        out += places[k : k + n]
    return out


def _blocks(batch: list[str]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Codes of texts side by side, and per text or piece of one: row, first place in the text, first and last window.

    Every text ends in spaces, so no window reaches into the next one.
    """
    held, spans, size = [], [], 0
    end = np.zeros(WINDOW + SPREAD, np.int32)
    for row, text in enumerate(batch):
        for first in range(0, len(text), PIECE):
            signs = np.concatenate([codes(text[first : first + PIECE + WINDOW + SPREAD]), end])
            windows = min(PIECE, len(text) - first)
            spans.append((row, first, size, size + windows))
            held.append(signs)
            size += len(signs)
            if size >= PIECE:
                yield np.concatenate(held), spans
                held, spans, size = [], [], 0
    if held:
        yield np.concatenate(held), spans


def top_windows(batch: list[str], weight: np.ndarray, most: int) -> list[list[tuple[float, np.ndarray]]]:
    """Scores and codes of each text's best windows apart from each other, the best first."""
    found: list[list[tuple[float, int, np.ndarray]]] = [[] for _ in batch]
    for signs, spans in _blocks(batch):
        scores = window_scores(signs, weight)
        for row, first, low, high in spans:
            part = scores[low:high].copy()
            for _ in range(most):
                at = int(part.argmax())
                if part[at] == -np.inf:
                    break
                place = low + at
                found[row].append((float(part[at]), first + at, signs[place : place + WINDOW + SPREAD].astype(np.uint8)))
                part[max(0, at - WINDOW + 1) : at + WINDOW] = -np.inf
    out = []
    for windows in found:
        kept: list[tuple[float, int, np.ndarray]] = []
        for window in sorted(windows, key=lambda w: (-w[0], w[1])):
            if len(kept) < most and all(abs(window[1] - k[1]) >= WINDOW for k in kept):
                kept.append(window)
        out.append([(score, signs) for score, _, signs in kept])
    return out


def text_features(scores: list[list[float]], lengths: list[int], bias: float) -> np.ndarray:
    """The two best windows' distances from the boundary, and the length.

    Long texts reach high scores by chance more often; below ``SHORT`` signs that is no matter.
    A window that a text lacks counts as the lowest.
    """
    out = np.full((len(scores), FEATURES), LOWEST)
    for row, own in enumerate(scores):
        out[row, : min(TOP, len(own))] = np.clip(np.array(own[:TOP]) + bias, LOWEST, HIGHEST)
    out[:, TOP] = np.log(np.maximum(SHORT, lengths)) / 4
    return out


# --- training ---------------------------------------------------------------
def changed(windows: np.ndarray) -> np.ndarray:
    """Windows with one sign put in between two, as insults are disguised: a space or another sign."""
    out = windows.copy()
    for k in range(len(windows)):
        at = 1 + k * 7 % (WINDOW - 1)
        out[k, at + 1 :] = windows[k, at:-1]
        out[k, at] = (0, 28, 28, 24, 27)[k % 5]
    return out


def fit(toxic: np.ndarray, clean: np.ndarray, landmarks: int) -> tuple[np.ndarray, float]:
    """Weight of every subsequence, and the bias, of a squared-hinge support vector machine.

    It is trained in the Nystroem space of the landmarks, half of them toxic.  As these have
    explicit feature maps, the trained function is one weight per subsequence, so that scoring
    a window costs no more than listing its subsequences.
    """
    windows = np.concatenate([toxic, clean])
    label = np.r_[np.ones(len(toxic)), -np.ones(len(clean))]
    draw = np.random.default_rng(1)
    half = landmarks // 2
    chosen = np.r_[
        draw.choice(len(toxic), min(half, len(toxic)), replace=False),
        len(toxic) + draw.choice(len(clean), min(half, len(clean)), replace=False),
    ]
    met = kernel(windows, windows[chosen]).astype(np.float64)
    scale = np.median(np.diag(met[chosen]))
    met /= scale
    values, vectors = np.linalg.eigh(met[chosen])
    kept = values > 1e-4 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    x = np.c_[met @ root, np.ones(len(windows))]
    cost = np.where(label > 0, len(clean) / len(toxic), 1.0)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(40):
        active = label * (x @ w) < 1
        xa = x[active]
        new = np.linalg.solve(ridge + xa.T @ (xa * cost[active, None]), xa.T @ (cost[active] * label[active]))
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    weight = np.zeros(CODES, np.float32)
    code, value = features(windows[chosen])
    for k, share in enumerate(root @ w[:-1] / scale):
        np.add.at(weight, code[k], value[k] * np.float32(share))
    return weight, float(w[-1])


def calibrate(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression of labels on text features, classes as frequent as given."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + 1e-2 * np.eye(x.shape[1]), x.T @ (label - p) - 1e-2 * w
        )
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """``text, toxic, learnt`` of a bounded sample of the training rows.

    Training rows are those whose crc32 of the doc_id as text isn't a multiple of five.  The
    sample holds at most ``per_class`` labelled ids of a class and so is safe to broadcast; three
    of four are learnt from, the others calibrate.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    train = known.where(~held_out())
    lot = F.xxhash64(F.lit(5), "doc_id")
    parts = [train.where(F.col("toxic") == k).orderBy(lot, "doc_id").limit(per_class) for k in (0, 1)]
    chosen = parts[0].union(parts[1]).withColumn("learnt", F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(4)) > 0)
    return stored(texts(docs).join(F.broadcast(stored(chosen)), "doc_id").select("text", "toxic", "learnt"))


def _clue_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of either class that hold each run of ``LENGTH`` signs, a row per run and task."""
    count = np.zeros((2, CODES), np.int64)
    end = np.zeros(SPREAD, np.int32)
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            code, _ = next(_subsequences(np.concatenate([codes(text), end])))
            count[toxic, np.unique(code)] += 1
    used = np.flatnonzero(count.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(count[k, used]) for k in (0, 1))], ["code", "good", "bad"])


def _clues(sample: DataFrame, settings: Settings) -> np.ndarray | None:
    """First weights: log odds of the runs that tell toxic texts of the sample from clean ones."""
    sizes = dict(sample.where("learnt").groupBy("toxic").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return None
    runs = sample.where("learnt").select("text", "toxic").mapInArrow(_clue_counts, "code long, good long, bad long")
    runs = runs.groupBy("code").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    bad, good, share = F.col("bad"), F.col("good"), sizes[1] / (sizes[0] + sizes[1])
    gain = F.when(bad > 0, bad * F.log(bad / ((bad + good) * share))).otherwise(0) + F.when(
        good > 0, good * F.log(good / ((bad + good) * (1 - share)))
    ).otherwise(0)
    odds = F.log((bad + 0.5) / (sizes[1] + 1)) - F.log((good + 0.5) / (sizes[0] + 1))
    telling = runs.where((gain > settings.least_gain) & (bad > (bad + good) * share))
    weight = np.zeros(CODES, np.float32)
    for code, value in telling.orderBy(gain.desc(), "code").limit(settings.clues).select("code", odds).collect():
        weight[code] = value
    return weight


_SEEN = "toxic int, learnt boolean, length int, scores array<double>, signs array<binary>"


def _seen(weight: np.ndarray):
    """The best windows of labelled texts, a row per text."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(0).to_pylist()
            best = top_windows(given, weight, LEARNT)
            columns = [
                batch.column(1),
                batch.column(2),
                pa.array([len(t) for t in given], pa.int32()),
                pa.array([[score for score, _ in own] for own in best], pa.list_(pa.float64())),
                pa.array([[signs.tobytes() for _, signs in own] for own in best], pa.list_(pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "learnt", "length", "scores", "signs"])

    return look


def _windows(found: list[bytes], most: int) -> np.ndarray:
    return np.frombuffer(b"".join(found[:most]), np.uint8).reshape(-1, WINDOW + SPREAD)


Model = tuple[np.ndarray, float, np.ndarray]


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Subsequence weights, bias and text weights, or None where the sample lacks a class.

    Labels belong to texts, so toxic windows have to be found: first by runs of signs that are
    commoner in toxic texts, then, round by round, by the machine so far.  Of a toxic text the
    best window is learnt as toxic, and further ones beyond the boundary; of a clean text the best ones are
    learnt as clean, those of earlier rounds too.  Texts are read by Spark tasks; the windows,
    a few thousand of ``WINDOW + SPREAD`` signs, are gathered.
    """
    with passing(docs.sparkSession):
        sample = labelled(docs, labels, settings.per_class)
        weight, bias = _clues(sample, settings), 0.0
        if weight is None:
            return None
        clean: list[bytes] = []
        for turn in range(settings.rounds + 1):
            seen = sample.mapInArrow(_seen(weight), _SEEN).collect()
            # In an order of their own, so that no order of rows changes a result.
            seen.sort(key=lambda r: (-max(r["scores"], default=LOWEST), r["signs"][:1], r["length"]))
            if turn == settings.rounds:
                break
            toxic, hard = [], []
            for row in (r for r in seen if r["learnt"]):
                if row["toxic"]:
                    toxic += [s for k, s in enumerate(row["signs"]) if k == 0 or row["scores"][k] + bias > 0]
                else:
                    hard += row["signs"][:TOP]
            clean = (hard + clean)[: settings.windows]
            if not toxic or not clean:
                return None
            found = _windows(toxic, settings.windows)
            weight, bias = fit(np.concatenate([found, changed(found)]), _windows(clean, settings.windows), settings.landmarks)
        rest = [r for r in seen if not r["learnt"]]
        # A small sample may lack a class among the rows kept for calibration.
        rest = rest if len({r["toxic"] for r in rest}) == 2 else seen
        x = text_features([r["scores"] for r in rest], [r["length"] for r in rest], bias)
        return weight, bias, calibrate(x, np.array([r["toxic"] for r in rest], float))


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Scores come from whole texts alone, however long.  NULL and empty texts score 0.  Where training rows lack a class every score is 0.  Rows with equal
    texts have equal scores; labels without a document, NULL labels and other columns are
    ignored (of several labels the highest counts); an empty table gives no rows.
    """
    scores = _scored(train(docs, labels, settings), 1)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, score in scores(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], ["doc_id", "score"])

    return texts(docs).mapInArrow(scored, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows and columns of ``docs`` whose texts aren't predicted to be toxic; nothing is shuffled."""
    scores = _scored(train(docs, labels, settings), docs.columns.index("text"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, score in scores(batches):
            yield part.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)


def _scored(model: Model | None, column: int):
    """Parts of batches with the scores of the texts in a column."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                score = np.zeros(part.num_rows)
                if model:
                    weight, bias, text_weight = model
                    given = [t or "" for t in part.column(column).to_pylist()]
                    best = [[s for s, _ in own] for own in top_windows(given, weight, TOP)]
                    x = np.c_[text_features(best, [len(t) for t in given], bias), np.ones(part.num_rows)]
                    score = np.where([bool(b) for b in best], 1 / (1 + np.exp(-np.clip(x @ text_weight, -30, 30))), 0.0)
                yield part, score

    return scores
