"""Word hashes of whole texts, computed over Arrow buffers with numpy.

A word is a maximal run of bytes that are not separators, compared after lower-casing A-Z.
Separators are ASCII, so runs never cut a UTF-8 character.  Words are told apart by 64-bit
hashes: a random value per byte, weighted by powers of an odd number, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 2**64)
SHINGLE = 5
_PLACE = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ``[^\\x20\\x09-\\x0D]+`` and ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing.
SPACES = separators((0x20, 0x20), (0x09, 0x0D))
SIGNS = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, dtype=np.uint64)
    return tuple(
        np.concatenate([one, np.cumprod(np.full(n, k, dtype=np.uint64))]) for k in (_STEP, _BACK)
    )


def _hashes(data: np.ndarray, starts: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of ``data``; no word runs past one of ``starts``."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gap = separator[data]
    opens = np.empty(len(data), dtype=bool)
    opens[0], opens[1:] = True, gap[:-1]
    opens[starts[starts < len(data)]] = True
    closes = np.empty(len(data), dtype=bool)
    closes[-1], closes[:-1] = True, gap[1:]
    cut = starts[(starts > 0) & (starts <= len(data))] - 1
    closes[cut] = True
    begin = np.flatnonzero(opens & ~gap)
    end = np.flatnonzero(closes & ~gap) + 1
    up, down = _powers(max(PIECE, 1 << int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin]), begin


def words(column: pa.Array, separator: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, word hashes, words per row)`` for runs of rows.

    A run holds about ``PIECE`` bytes; a longer text is one run, hashed piece by piece.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, buffer = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        after = max(row + 1, int(np.searchsorted(bounds, bounds[row] + PIECE, side="right")) - 1)
        low, high = int(bounds[row]), int(bounds[after])
        if high - low <= 2 * PIECE:
            inner = bounds[row : after + 1] - low
            hashes, begin = _hashes(data[low:high], inner[:-1], separator)
            counts = np.diff(np.searchsorted(begin, inner))
        else:
            parts, at, none = [], low, np.zeros(0, np.int64)
            while at < high:
                to = min(at + PIECE, high)
                while to < high and not separator[data[to]]:
                    to += 1
                parts.append(_hashes(data[at:to], none, separator)[0])
                at = to
            hashes = np.concatenate(parts)
            counts = np.array([len(hashes)])
        yield row, after, hashes, counts
        row = after


def shingles(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words and the number per text; a shorter text is one run."""
    size = np.minimum(counts, SHINGLE)
    per_text = np.where(counts > 0, counts - size + 1, 0)
    first = np.repeat(np.cumsum(counts) - counts, per_text)
    inside = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    at, size = first + inside, np.repeat(size, per_text)
    padded = np.concatenate([hashes, np.zeros(SHINGLE, dtype=np.uint64)])
    value = size.astype(np.uint64)
    for k in range(SHINGLE):
        value = value + np.where(k < size, padded[at + k], np.uint64(0)) * _PLACE[k]
    return mix(value), per_text
