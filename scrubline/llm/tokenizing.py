"""Token ids of whole texts, as the tokenizers library gives them, with each unit encoded once.

A text is cut where the tokenizer's own rules always cut it: byte-level pre-tokenizers keep at
most one leading space with a run of non-space, and word-level ones drop white space.  The
ids of a text are then the ids of its units in turn.  Units repeat a lot, so a bounded
table of units answers most of them.  Tests compare with the library on whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: Unicode White_Space, as the library's patterns see it.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACED = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
#: White space beyond that of ``ascii_split_whitespace``, in the syntax of Arrow's patterns.
_ODD_SPACE = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNSPACED = re.compile(f"[^{_SPACE}]+")
#: Where str.split and the patterns disagree about white space.
_DISPUTED = re.compile("[\x1c-\x1f]").search
#: Letters that the normalizers only lower-case, then ASCII signs: two pre-tokens at most.
_PLAIN = re.compile("( ?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?|*$%&#)\"-]*)")
REMEMBERED = 400_000


def _byte_letters() -> list[str]:
    """The character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    return [letters.get(b) or chr(256 + hidden.index(b)) for b in range(256)]


class Units:
    """Ids of texts by a table of units that holds at most twice ``REMEMBERED`` of them.

    A unit that isn't there is mostly a known word in another case or with other signs after
    it, so its word is looked up in a second table of the same size.  Ids are little-endian, two bytes each where the vocabulary allows it, else four.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"] for t in settings["added_tokens"]]
        self.lower = settings["normalizer"] is not None
        self.letters = dict(enumerate(_byte_letters()))
        self.model = self.tokenizer.model
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.kind).itemsize
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def packed(self, ids: list[int]) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _part(self, plain: str) -> bytes:
        """Ids of one pre-token."""
        ids = self.words.get(plain)
        if ids is None:
            ids = self.old_words.get(plain)
            if ids is None:
                shown = plain.encode().decode("latin-1").translate(self.letters)
                ids = self.packed([t.id for t in self.model.tokenize(shown)])
            if len(self.words) >= REMEMBERED:
                self.old_words, self.words = self.words, {}
            self.words[plain] = ids
        return ids

    def _encode(self, unit: str) -> bytes:
        if self.lower and unit.isascii() and unit.isalpha():
            return self._part(unit.lower())
        plain = _PLAIN.fullmatch(unit)
        if not plain:
            return self.packed(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        space, word, signs = plain.groups()
        ids = self._part(word.lower() if self.lower else space + word)
        return ids + self._part(signs) if signs else ids

    def cut(self, text: str) -> list[str]:
        if not self.lower:
            return _SPACED.findall(text)
        return _UNSPACED.findall(text) if _DISPUTED(text) else text.split()

    def of_unit(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            ids = self._encode(unit)
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[unit] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """All ids of a text."""
        if any(s in text for s in self.special):
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        units = self.cut(text)
        found = list(map(self.young.get, units))
        if None in found:
            found = [self.of_unit(u) if ids is None else ids for u, ids in zip(units, found)]
        return b"".join(found)

    def ids_of(self, column: pa.Array) -> list[bytes]:
        """All ids of every text of a batch.

        Where units end at white space, the units of all texts are told apart first, so that each
        distinct one is looked up once per batch.
        """
        if not self.lower:
            return [self.ids(text) for text in column.to_pylist()]
        odd = pc.match_substring_regex(column, "|".join([_ODD_SPACE, *map(re.escape, self.special)]))
        out: list[bytes] = [b""] * len(column)
        odd = odd.to_numpy(zero_copy_only=False)
        for row in np.flatnonzero(odd):
            out[row] = self.ids(column[row].as_py())
        plain = np.flatnonzero(~odd)
        lists = pc.ascii_split_whitespace(column.take(pa.array(plain)).cast(pa.large_string()))
        units = lists.flatten().dictionary_encode()
        known = self.young
        found = [known.get(u) or self.of_unit(u) if u else b"" for u in units.dictionary.to_numpy(zero_copy_only=False).tolist()]
        size = np.array([len(ids) // self.width for ids in found], np.int64)
        start = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(found), f"<u{self.width}")
        code = units.indices.to_numpy()
        each = size[code]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = ids[np.repeat(start[code] - ends[:-1], each) + np.arange(ends[-1])]
        bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        for row, low, high in zip(plain, bounds[:-1], bounds[1:]):
            out[row] = flat[low:high].tobytes()
        return out


_LOADED: dict[str, Units] = {}


def units(path: str) -> Units:
    """One table per tokenizer and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Units(path)
    return _LOADED[path]


def version(path: str) -> str:
    """Digest of the tokenizer file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()
