"""Clustering keys: values with the same key are probably variants of one another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.functions.unicode import fold_accents, strip_spaces


def folded_lower(text: Column) -> Column:
    """First half of the fingerprint, kept apart so that accent folding is evaluated once."""
    return fold_accents(F.lower(strip_spaces(text)))


def fingerprint(folded: Column) -> Column:
    """Distinct words of :func:`folded_lower` text in order, punctuation and controls removed."""
    words = F.split(F.trim(F.regexp_replace(folded, r"[\p{Punct}\p{Cntrl}\p{P}\p{S}]", "")), r"\s+")
    return F.array_join(F.sort_array(F.array_distinct(words)), " ")


def letters(text: Column) -> Column:
    """Upper-case A to Z only; other characters are dropped."""
    return F.regexp_replace(F.upper(text), "[^A-Z]", "")


# Phonetic rules as (pattern, code), applied in order.  Codes are digits or lower-case
# letters, so that later patterns never mistake a code for a letter still to be read.
COLOGNE_RULES = (
    ("[DT](?=[CSZ])", "8"),
    ("[DT]", "2"),
    ("^C(?=[AHKLOQRUX])", "k"),
    ("^C", "s"),
    ("(?<=[SZ])C", "s"),
    ("C(?=[AHKOQUX])", "k"),
    ("C", "s"),
    ("(?<=[ksKQ])X", "8"),
    ("X", "48"),
    ("P(?=H)", "3"),
    ("[BP]", "1"),
    ("[FVW]", "3"),
    ("[GKQk]", "4"),
    ("L", "5"),
    ("[MN]", "6"),
    ("R", "7"),
    ("[SZs]", "8"),
    ("[AEIJOUY]", "0"),
    ("H", ""),
    (r"(.)\1+", "$1"),
    ("(?<=.)0", ""),
)

METAPHONE_RULES = (
    (r"([ABD-Z])\1+", "$1"),
    ("^(?:KN|GN|PN)", "N"),
    ("^AE", "E"),
    ("^WR", "R"),
    ("^X", "S"),
    ("^WH", "W"),
    ("MB$", "M"),
    ("SCH", "sk"),
    ("CIA", "xA"),
    ("TCH", "x"),
    ("CH", "x"),
    ("C(?=[IEY])", "s"),
    ("CK", "k"),
    ("C", "k"),
    ("DG(?=[EIY])", "j"),
    ("D", "t"),
    ("GH(?=[^AEIOU])", ""),
    ("GN(?:ED)?$", "n"),
    ("G(?=[IEY])", "j"),
    ("G", "k"),
    ("PH", "f"),
    ("P", "p"),
    ("Q", "k"),
    ("SH|S(?=IO|IA)", "x"),
    ("TH", "0"),
    ("T(?=IA|IO)", "x"),
    ("T", "t"),
    ("S", "s"),
    ("V", "f"),
    ("W(?![AEIOU])", ""),
    ("X", "ks"),
    ("Y(?![AEIOU])", ""),
    ("Z", "s"),
    ("(?<=[AEIOU])H(?![AEIOU])", ""),
    ("(?<=.)[AEIOU]", ""),
)


def _coded(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    for pattern, code in rules:
        text = F.regexp_replace(text, pattern, code)
    return text


def cologne(text: Column) -> Column:
    """Cologne phonetic code of the letters of a text."""
    return _coded(letters(text), COLOGNE_RULES)


def metaphone(text: Column) -> Column:
    """Classic metaphone code of the letters of a text."""
    return F.upper(_coded(letters(text), METAPHONE_RULES))


def soundex(text: Column) -> Column:
    return F.soundex(letters(text))
