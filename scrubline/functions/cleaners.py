"""Value cleaners as Spark column expressions.

A cleaner turns one text column into a clean value and the operations that altered it, in
the order they were applied.  An operation is reported only when it changed something.

A cleaner is a list of layers, each a small projection over named columns.  Layers keep
every expensive expression (a regex, a parse) in exactly one place: later layers refer to
it by name, so neither the optimizer nor code generation repeats it.  Catalyst merges
layers again wherever that costs nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.functions.unicode import (
    LETTER_OR_DIGIT,
    NBSP,
    NON_ASCII,
    UNTIDY,
    collapse_spaces,
    fold_accents,
    strip_spaces,
)
from scrubline.vocab import Op

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER = r"^[+-]?\d+$"
MAX_DOUBLE = 1.7976931348623157e308

Lookup = Callable[[str], Column]
Layer = Callable[[Lookup], dict[str, Column]]


@dataclass(frozen=True)
class Cleaner:
    """Layers from the column ``raw`` to ``value`` and ``ops``; ``names`` is what ops may hold."""

    layers: tuple[Layer, ...]
    names: tuple[str, ...]

    @staticmethod
    def of(build: Callable[[Column], Column], names: tuple[str, ...]) -> Cleaner:
        """A cleaner from a function giving ``struct<value, ops>``, an Arrow ``pandas_udf`` included."""
        return Cleaner(
            (
                lambda c: {"both": build(c("raw"))},
                lambda c: {"value": c("both")["value"], "ops": c("both")["ops"]},
            ),
            names,
        )

    @staticmethod
    def from_arrow(build: Callable[[pa.Array], tuple[pa.Array, dict[str, pa.Array]]], names: tuple[str, ...]) -> Cleaner:
        """A cleaner from a function over Arrow text arrays.

        ``build`` gives the clean texts and, per operation, which rows it changed (NULL: not).  It
        runs in Python workers, batch by batch; as it counts as nondeterministic, the
        optimizer neither repeats it for a second use of its result nor moves a filter below it.
        """

        @F.arrow_udf("struct<value:string,ops:array<string>>")
        def both(raw: pa.Array) -> pa.Array:
            value, done = build(raw)
            marks = [(name, pc.fill_null(done[name], False)) for name in names if name in done]
            ops = [[name for name, mark in marks if mark[k].as_py()] for k in range(len(raw))]
            return pa.StructArray.from_arrays(
                [value.cast(pa.string()), pa.array(ops, pa.list_(pa.string()))], ["value", "ops"]
            )

        return Cleaner.of(both.asNondeterministic(), names)

    def run(self, df: DataFrame, source: Column, prefix: str) -> DataFrame:
        """Add ``<prefix>_value`` and ``<prefix>_ops``."""
        return run_cleaners(df, [(self, source, prefix)])


def run_cleaners(df: DataFrame, jobs: list[tuple[Cleaner, Column, str]]) -> DataFrame:
    """Run (cleaner, source, prefix) jobs side by side, layer by layer."""

    def look(source: Column, prefix: str) -> Lookup:
        return lambda name: source if name == "raw" else F.col(f"{prefix}_{name}")

    columns = df.columns
    for depth in range(max(len(cleaner.layers) for cleaner, _, _ in jobs)):
        made = {}
        for cleaner, source, prefix in jobs:
            if depth < len(cleaner.layers):
                layer = cleaner.layers[depth](look(source, prefix))
                made.update({f"{prefix}_{name}": column for name, column in layer.items()})
        df = df.withColumns(made)
    results = [f"{prefix}_{name}" for _, _, prefix in jobs for name in ("value", "ops")]
    return df.select(*(F.col(f"`{n}`") for n in columns), *results)


def op_list(*ops: tuple[Column, str]) -> Column:
    """The names whose condition is true, in order."""
    named = [F.when(cond, F.lit(name)).otherwise(F.lit("")) for cond, name in ops]
    return F.array_remove(F.array(*named), "")


# --- normalized text, the base of all others --------------------------------
def _where_untidy(c: Lookup, changed: Column, otherwise: str) -> Column:
    return F.when(c("untidy"), changed).otherwise(c(otherwise))


# One cheap scan finds the few cells that hold anything but single inner spaces and
# printable ASCII; only those meet the Unicode-aware replacements.
TEXT_LAYERS: tuple[Layer, ...] = (
    lambda c: {"untidy": c("raw").rlike(UNTIDY)},
    lambda c: {"folded": _where_untidy(c, F.replace(c("raw"), F.lit(NBSP), F.lit(" ")), "raw")},
    lambda c: {"stripped": _where_untidy(c, strip_spaces(c("folded")), "folded")},
    lambda c: {"single": _where_untidy(c, collapse_spaces(c("stripped")), "stripped")},
    lambda c: {
        "text": F.when(~c("single").isin(*V.NULL_TOKENS), c("single")),
        "trimmed": c("untidy") & (c("stripped") != c("folded")),
        "collapsed": c("untidy") & (c("single") != c("stripped")),
    },
)


def _text_ops(c: Lookup) -> list[tuple[Column, str]]:
    return [(c("trimmed"), Op.TRIMMED), (c("collapsed"), Op.SPACES_COLLAPSED)]


TEXT = Cleaner(
    (*TEXT_LAYERS, lambda c: {"value": c("text"), "ops": op_list(*_text_ops(c))}),
    (Op.TRIMMED, Op.SPACES_COLLAPSED),
)


# --- numbers ----------------------------------------------------------------
def _finite(number: Column) -> Column:
    return F.when(F.abs(number) <= MAX_DOUBLE, number)


def _parsed(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text).try_cast("double")


def two_decimals(number: Column) -> Column:
    """Two-decimal text; binary half cases round as C ``%.2f`` does."""
    return F.call_function("format_number", number, F.lit("0.00"))


def _where_odd(layers: tuple[Layer, ...]) -> tuple[Layer, ...]:
    """The same layers over the cells in ``odd`` alone."""
    return tuple(
        lambda c, layer=layer: layer(lambda name: c("odd" if name == "raw" else name)) for layer in layers
    )


def _filled(c: Lookup) -> Column:
    return F.when(c("raw") != "", c("raw"))


def _ops(*names: str) -> Column:
    return F.array(*(F.lit(n) for n in names)).cast("array<string>")


# Both number cleaners read a cell as the number it is first.  A cell that this number is written
# as, or an empty one, is done; only the others, which are ``odd``, meet the scans and parses.

# Whole number or NULL.  Decimals truncate toward zero; digits never pass through floats.
INT = Cleaner(
    (
        lambda c: {"exact": _filled(c).try_cast("bigint")},
        lambda c: {"odd": F.when(c("exact").cast("string") == c("raw"), None).otherwise(_filled(c))},
        *_where_odd(TEXT_LAYERS),
        lambda c: {"plain": F.replace(c("text"), F.lit(","), F.lit(""))},
        lambda c: {
            "whole": F.when(c("plain").rlike(INTEGER), c("plain")),
            "number": F.when(~c("plain").rlike(INTEGER), _parsed(c("plain"))),
        },
        lambda c: {
            "value": F.when(c("odd").isNull(), c("exact")).otherwise(
                F.coalesce(c("whole").try_cast("bigint"), c("number").try_cast("bigint"))
            )
        },
        lambda c: {
            "ops": F.when(c("odd").isNull(), _ops()).otherwise(
                op_list(*_text_ops(c), (c("value").cast("string") != c("text"), Op.TO_INT))
            )
        },
    ),
    (Op.TRIMMED, Op.SPACES_COLLAPSED, Op.TO_INT),
)

#: Prices of up to 14 digits are the same text whether written from a decimal or from a double.
EXACT_PRICE = "decimal(14,2)"


def _plainly_written(c: Lookup) -> Column:
    """The cell is its price in two decimals, or in fewer by what they lack at the end."""
    return c("exact").startswith(c("raw")) & (F.length(c("raw")) >= F.length(c("exact")) - 3)


# Price text with two decimals or NULL.
DECIMAL = Cleaner(
    (
        lambda c: {"exact": _filled(c).try_cast(EXACT_PRICE).cast("string")},
        lambda c: {"odd": F.when(_plainly_written(c), None).otherwise(_filled(c))},
        *_where_odd(TEXT_LAYERS),
        lambda c: {
            "plain": F.replace(F.replace(c("text"), F.lit(","), F.lit("")), F.lit("$"), F.lit(""))
        },
        lambda c: {"number": _parsed(c("plain"))},
        lambda c: {
            "value": F.when(c("odd").isNull(), c("exact")).otherwise(two_decimals(_finite(c("number"))))
        },
        lambda c: {
            "ops": F.when(c("odd").isNotNull(), op_list(*_text_ops(c), (c("value") != c("text"), Op.TO_DECIMAL_2DP)))
            .when(c("value") != c("raw"), _ops(Op.TO_DECIMAL_2DP))
            .otherwise(_ops())
        },
    ),
    (Op.TRIMMED, Op.SPACES_COLLAPSED, Op.TO_DECIMAL_2DP),
)


# --- dates and currencies ---------------------------------------------------
def date_cleaner(
    min_year: int = V.MIN_PLAUSIBLE_YEAR, max_year: int = V.MAX_PLAUSIBLE_YEAR
) -> Cleaner:
    """Year, month, day from an ISO date prefix, all NULL unless every part is plausible."""

    def split(c: Lookup) -> dict[str, Column]:
        iso = F.when(c("text").rlike(r"^\d{4}-\d{2}-\d{2}"), c("text"))
        return {
            "year": F.substring(iso, 1, 4).cast("int"),
            "month": F.substring(iso, 6, 2).cast("int"),
            "day": F.substring(iso, 9, 2).cast("int"),
        }

    def judge(c: Lookup) -> dict[str, Column]:
        return {
            "usable": c("year").between(min_year, max_year)
            & c("month").between(1, 12)
            & c("day").between(1, 31)
        }

    def build(c: Lookup) -> dict[str, Column]:
        parts = (F.when(c("usable"), c(n)).alias(n) for n in ("year", "month", "day"))
        return {
            "value": F.struct(*parts),
            "ops": op_list(*_text_ops(c), (c("usable"), Op.DATE_SPLIT)),
        }

    return Cleaner(
        (*TEXT_LAYERS, split, judge, build), (Op.TRIMMED, Op.SPACES_COLLAPSED, Op.DATE_SPLIT)
    )


def currency_cleaner(mapping: dict[str, str] | None = None) -> Cleaner:
    """Known labels become their abbreviation, others pass through."""
    known = mapping or V.CURRENCY_MAP

    def lookup(c: Lookup) -> dict[str, Column]:
        entries = [F.lit(x) for pair in known.items() for x in pair]
        return {"mapped": F.create_map(*entries)[c("text")]}

    def build(c: Lookup) -> dict[str, Column]:
        return {
            "value": F.coalesce(c("mapped"), c("text")),
            "ops": op_list(*_text_ops(c), (c("mapped").isNotNull(), Op.CURRENCY_MAPPED)),
        }

    return Cleaner(
        (*TEXT_LAYERS, lookup, build), (Op.TRIMMED, Op.SPACES_COLLAPSED, Op.CURRENCY_MAPPED)
    )


DATE = date_cleaner()
CURRENCY = currency_cleaner()


# --- dish names -------------------------------------------------------------
_NOT_IN_NAMES = "".join(c for c in map(chr, range(128)) if not ("A" <= c <= "Z" or "0" <= c <= "9" or c in " ',"))


def _name_verdict(c: Lookup) -> dict[str, Column]:
    named = F.coalesce(c("text").rlike(LETTER_OR_DIGIT), F.lit(False))
    return {"named": named, "latin": named & ~c("upper").rlike(NON_ASCII)}


def _name_ops(c: Lookup) -> Column:
    named, latin = c("named"), c("latin")
    return op_list(
        *_text_ops(c),
        (named & (c("quoted") != c("text")), Op.QUOTES_NORMALIZED),
        (named & (c("plain") != c("quoted")), Op.ACCENTS_FOLDED),
        (named & (c("upper") != c("plain")), Op.UPPERCASED),
        (latin & (c("expanded") != c("upper")), Op.AMPERSAND_EXPANDED),
        (latin & (c("spaced") != c("expanded")), Op.PUNCT_TO_SPACE),
        (latin & (c("kept") != c("spaced")), Op.PUNCT_REMOVED),
        (latin & (c("tidy") != c("kept")) & ~c("collapsed"), Op.SPACES_COLLAPSED),
        (~c("good"), Op.MARKED_UNKNOWN),
    )


# Upper-case ASCII letters, digits, space, apostrophe and comma, or UNKNOWN.  The order of
# the layers is part of the result: quotes before accents, accents before case, words for
# "&" before separators, deletion last.
NAME = Cleaner(
    (
        *TEXT_LAYERS,
        lambda c: {"quoted": F.translate(c("text"), V.NAME_QUOTES_FROM, V.NAME_QUOTES_TO)},
        lambda c: {"plain": fold_accents(c("quoted"))},
        lambda c: {"upper": F.upper(c("plain"))},
        _name_verdict,
        lambda c: {"expanded": F.replace(c("upper"), F.lit("&"), F.lit(V.NAME_AMPERSAND))},
        lambda c: {
            "spaced": F.translate(c("expanded"), V.NAME_SEPARATORS, " " * len(V.NAME_SEPARATORS))
        },
        # Only names in ASCII get further; what else they hold is deleted by a table of it.
        lambda c: {"kept": F.when(c("latin"), F.translate(c("spaced"), _NOT_IN_NAMES, ""))},
        lambda c: {"tidy": F.trim(F.regexp_replace(c("kept"), "  +", " "))},
        lambda c: {"good": c("latin") & c("tidy").rlike("[A-Z0-9]")},
        lambda c: {
            "value": F.when(c("good"), c("tidy")).otherwise(V.UNKNOWN_NAME),
            "ops": _name_ops(c),
        },
    ),
    (
        Op.TRIMMED,
        Op.SPACES_COLLAPSED,
        Op.QUOTES_NORMALIZED,
        Op.ACCENTS_FOLDED,
        Op.UPPERCASED,
        Op.AMPERSAND_EXPANDED,
        Op.PUNCT_TO_SPACE,
        Op.PUNCT_REMOVED,
        Op.MARKED_UNKNOWN,
    ),
)
