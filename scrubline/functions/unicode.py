"""Unicode helpers: whitespace, letters-or-digits, and compatibility accent folding.

Decomposition runs inside the JVM through the ICU library that Spark itself ships
(it backs SQL collations), so no row travels to Python.  The combining marks are listed
once on the driver from ``unicodedata``.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = "\u00a0"

# Everything str.isspace() accepts but the plain space; Java's \s knows ASCII only.
OTHER_SPACES = r"\x09-\x0d\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CLASS = rf"[\x20{OTHER_SPACES}]"
# Leading, trailing or doubled spaces, or any character outside printable ASCII.
UNTIDY = r"^ | \z|  |[^ -~]"
NON_ASCII = r"[^\x00-\x7f]"
LETTER_OR_DIGIT = r"[\p{L}\p{N}]"


@lru_cache(maxsize=1)
def combining_marks() -> str:
    """Every code point with a non-zero canonical combining class; surrogates have none."""
    return "".join(chr(cp) for cp in range(sys.maxunicode + 1) if unicodedata.combining(chr(cp)))


def strip_spaces(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(text, rf"^{SPACE_CLASS}++|{SPACE_CLASS}++\z", "")


def has_text(text: Column) -> Column:
    """Anything but Unicode whitespace: found at the first such sign, where stripping looks at all."""
    return text.rlike(rf"[^\x20{OTHER_SPACES}]")


def collapse_spaces(text: Column) -> Column:
    """Turn every run of Unicode whitespace into one space; a single space, which is one, isn't matched."""
    return F.regexp_replace(text, rf"[{OTHER_SPACES}]{SPACE_CLASS}*+| {SPACE_CLASS}++", " ")


def fold_accents(text: Column) -> Column:
    """Compatibility-decompose, then delete combining marks; ASCII text is left alone.

    The reflective call counts as non-deterministic for the optimizer, hence it stays in
    the projection that first computes it and is never duplicated.  Marks are deleted by a
    table of them: a class of all their ranges is tried range by range on every letter.
    """
    decomposed = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), text, F.lit(True)
    )
    return F.when(
        text.rlike(NON_ASCII), F.translate(decomposed, combining_marks(), "")
    ).otherwise(text)
