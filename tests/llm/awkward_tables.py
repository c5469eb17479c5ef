"""Awkward rows and plain restatements shared by the tests of this folder."""

from __future__ import annotations

import random
import re

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ("pos", "size", "rid", "key", "_key", "n", "term", "place", "score", "n_words", "fingerprint", "times", "shard")


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def awkward_rows():
    """NULLs in every column, empty, blank, tiny and very long texts, copies, repeated rows."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeiou") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = say(60)
    near = base.split()
    near[30] = "changed"
    rows = [
        (0, None, "en", "src0", 0), (1, "", None, "src0", None), (2, " \t\n ", "en", None, 3),
        (3, "word", "en", "src1", 4), (4, "Two Words", "en", "src1", 9), (5, "é中\U0001f600 ß", "xx", "src2", 5),
        (6, base, "en", "src0", 1), (7, base, "en", "src1", 1), (8, " ".join(near), "en", "src0", 1),
        (9, base.upper(), "en", None, 1), (10, say(20000), "en", "src2", 1), (11, "x" * 200_000, "en", "src2", 1),
        (None, say(40), "en", "src0", 1), (None, None, None, None, None), (13, say(50), "en", "src3", 1),
        (13, say(30), "en", "src3", 1), (14, say(25), "en", "src1", 1), (14, None, "en", "src1", 1),
        (2**62, say(30), "en", "src0", 1), (-5, say(30), "en", "src0", 1),
    ]
    rows += [(100 + k, say(rng.randint(1, 80)), "en", f"src{k % 4}", 1) for k in range(60)]
    rows += [rows[6], rows[6], (200, "word", "en", "src0", 1), (201, "word", "en", "src0", 1)]
    return rows
