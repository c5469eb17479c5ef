"""Cell tests against plain restatements of the rules."""

from __future__ import annotations

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.functions import CURRENCY, DATE, DECIMAL, INT, NAME, TEXT, Cleaner, keys
from scrubline.functions.unicode import fold_accents


def clean(spark, cleaner, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, raw string")
    done = cleaner.run(df, F.col("raw"), "c").orderBy("i").collect()
    return [(r.c_value, list(r.c_ops)) for r in done]


def text_rule(cell):
    """What normalizing must give, written as word splitting."""
    if cell is None:
        return None, []
    flat = cell.replace("\u00a0", " ")
    inner = flat.strip()
    single = " ".join(inner.split())
    ops = (["trimmed"] if inner != flat else []) + (["spaces_collapsed"] if single != inner else [])
    return (None if single in V.NULL_TOKENS else single), ops


CELLS = [
    None, "", " ", "a", " a ", "a  b", "a\tb", "a\u00a0b", "\u00a0a", "a \u00a0b", "\x1ca", "a\n",
    "nan", " NULL ", "\\N", "-", "?", "--", "a\u3000b", "x \u0085", "none", "None", "a\u2003\u2003b",
]


def test_text(spark):
    assert clean(spark, TEXT, CELLS) == [text_rule(c) for c in CELLS]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=12), min_size=80, max_size=120))
def test_text_on_any_characters(spark, cells):
    assert clean(spark, TEXT, cells) == [text_rule(c) for c in cells]


@pytest.mark.parametrize(
    "cell, value, ops",
    [
        ("12", 12, []),
        (" 12 ", 12, ["trimmed"]),
        ("1,234", 1234, ["to_int"]),
        ("12.7", 12, ["to_int"]),
        ("-12.7", -12, ["to_int"]),
        ("007", 7, ["to_int"]),
        ("1e3", 1000, ["to_int"]),
        ("9007199254740993", 9007199254740993, []),
        ("abc", None, []),
        ("12d", None, []),
        ("1_000", None, []),
        ("Infinity", None, []),
        ("", None, []),
        (None, None, []),
    ],
)
def test_int(spark, cell, value, ops):
    assert clean(spark, INT, [cell]) == [(value, ops)]


def test_decimal(spark):
    cells = ["0.2", "0.0", "1.0", "0.25", "1,234.5", "$3", "0.125", "2.675", "-0.001", "1e3", "5.", ".5", "1d", "nan", "1e999", "12.50"]
    numbers = [0.2, 0.0, 1.0, 0.25, 1234.5, 3.0, 0.125, 2.675, -0.001, 1000.0, 5.0, 0.5, None, None, None, 12.5]
    expected = [None if n is None else f"{n:.2f}" for n in numbers]
    got = clean(spark, DECIMAL, cells)
    assert [v for v, _ in got] == expected
    assert [o for _, o in got] == [
        ["to_decimal_2dp"] if e is not None and e != c else [] for c, e in zip(cells, expected)
    ]


def test_date(spark):
    cells = ["1900-04-16T00:00:00Z", "0001-01-01", "0190-03-06", "1091-01-01", "2928-01-01", "1850-13-01", "1850-02-31", "1850-1-1", "", "1840-01-01", "2026-12-31", "2027-01-01"]
    got = [tuple(v) if v else v for v, _ in clean(spark, DATE, cells)]
    none = (None, None, None)
    assert got == [(1900, 4, 16), none, none, none, none, none, (1850, 2, 31), none, none, (1840, 1, 1), (2026, 12, 31), none]


def test_currency(spark):
    assert clean(spark, CURRENCY, ["Dollars", " Dollars", "Francs", ""]) == [
        ("USD", ["currency_mapped"]),
        ("USD", ["trimmed", "currency_mapped"]),
        ("Francs", []),
        (None, []),
    ]


NAMES = {
    "&": ("UNKNOWN", ["marked_unknown"]),
    "": ("UNKNOWN", ["marked_unknown"]),
    None: ("UNKNOWN", ["marked_unknown"]),
    "Pflaumen-Kompott": ("PFLAUMEN KOMPOTT", ["uppercased", "punct_to_space"]),
    "Médoc": ("MEDOC", ["accents_folded", "uppercased"]),
    "?? Fry?? Stew": ("FRY STEW", ["uppercased", "punct_removed", "spaces_collapsed"]),
    "A & B": ("A AND B", ["ampersand_expanded", "spaces_collapsed"]),
    "CHEF’S": ("CHEF'S", ["quotes_normalized"]),
    "½ pint": ("UNKNOWN", ["accents_folded", "uppercased", "marked_unknown"]),
    "œuf": ("UNKNOWN", ["uppercased", "marked_unknown"]),
    "Straße": ("STRASSE", ["uppercased"]),
    "ﬁsh™": ("FISHTM", ["accents_folded", "uppercased"]),
    "茶": ("UNKNOWN", ["marked_unknown"]),
    " a  b ": ("A B", ["trimmed", "spaces_collapsed", "uppercased"]),
    ", Raw, on Half Shell": (", RAW, ON HALF SHELL", ["uppercased"]),
}


def test_names(spark):
    assert dict(zip(NAMES, clean(spark, NAME, list(NAMES)))) == NAMES


def test_names_keep_their_charset_and_are_stable(spark):
    cells = ["Crème brûlée (für 2)", "Ünï–cödé “quote”", "x" * 5000 + " é", "A & B", "100% beef!", "~/~"]
    once = [v for v, _ in clean(spark, NAME, cells)]
    assert all(set(v) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ',") for v in once)
    assert [v for v, _ in clean(spark, NAME, once)] == once


def test_accent_folding_of_every_plane(spark):
    cells = [chr(c) + "a" + chr(c) for c in [*range(0x80, 0xD800), *range(0xE000, 0x11000)]]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, raw string")
    got = [r[0] for r in frame.orderBy("i").select(fold_accents(F.col("raw"))).collect()]
    expected = ["".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in cells]
    differing = [c for c, g, e in zip(cells, got, expected) if g != e]
    assert len(differing) <= 20  # the two libraries may know different Unicode versions


def test_user_cleaner(spark):
    shout = Cleaner.of(lambda c: F.struct(F.upper(c).alias("value"), F.array(F.lit("shouted")).alias("ops")), ("shouted",))
    assert clean(spark, shout, ["ab"]) == [("AB", ["shouted"])]


def test_phonetic_and_fingerprint_keys(spark):
    def apply(expression, cells):
        df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, raw string")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("raw"))).collect()]

    assert apply(keys.cologne, ["WIKIPEDIA", "BRESCHNEW", "MULLERLUDENSCHEIDT", "CAFEE", "COFEE", "KAFEE"]) == [
        "3412", "17863", "65752682", "43", "43", "43",
    ]
    tea = apply(keys.metaphone, ["THE", "THEE", "KNIGHT", "NIGHT", "PHONE", "FONE"])
    assert tea[0] == tea[1] and tea[2] == tea[3] and tea[4] == tea[5]
    folded = apply(lambda c: keys.fingerprint(keys.folded_lower(c)), ["Beef, Roast", "Roast beef.", " roast BEEF roast", "Rôast beef"])
    assert set(folded) == {"beef roast"}


def odd_cells(spark, cleaner, cells):
    """The cells that aren't done after their first reading."""
    df = spark.createDataFrame([(c,) for c in cells], "raw string")
    for layer in cleaner.layers[:2]:
        df = df.withColumns(layer(F.col))
    return [r.odd for r in df.where("odd is not null").collect()]


def test_plainly_written_numbers_meet_no_scans(spark):
    whole = ["12", "-5", "0", "-9223372036854775808", "", None]
    assert odd_cells(spark, INT, whole) == []
    prices = ["12", "12.", "12.5", "-0.50", "0", "999999999999.99", "", None]
    assert odd_cells(spark, DECIMAL, prices) == []


def test_all_other_numbers_do(spark):
    cells = [" 12", "12 ", "007", "-0", "+5", "1e3", "1,234", "nan", "12 ", "9223372036854775808"]
    assert odd_cells(spark, INT, [*cells, "12.0"]) == [*cells, "12.0"]
    prices = [*cells, "12.345", "-0.0", ".5", "1000000000000.00", "12d"]
    assert odd_cells(spark, DECIMAL, prices) == prices


def test_plain_prices_are_written_as_doubles_are(spark):
    cells = ["0.1", "1.15", "2.5", "-3", "4.", "1234567.89", "999999999999.99", "100000000000.01"]
    expected = [(f"{float(c):.2f}", [] if f"{float(c):.2f}" == c else ["to_decimal_2dp"]) for c in cells]
    assert clean(spark, DECIMAL, cells) == expected
