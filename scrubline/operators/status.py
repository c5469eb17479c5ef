"""Row verdicts: status, warnings and exclusions of every cleaned row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.functions.unicode import strip_spaces
from scrubline.operators.stages import Trace
from scrubline.vocab import Reason, Status


def _blank(raw: Column) -> Column:
    return raw.isNull() | strip_spaces(raw).isin(*V.NULL_TOKENS)


def _warnings(trace: Trace) -> list[tuple[Column, str]]:
    """(condition, ``column:reason``) from raw cells against their cleaned values."""
    first, last = F.col, {n: F.col(p) for n, p in trace.layouts[-1].items()}
    found: list[tuple[Column, str]] = []

    def add(column: str, reason: str, condition: Column) -> None:
        found.append((condition, f"{column}:{reason}"))

    for column in V.RAW_COLUMNS[trace.table]:
        raw = first(column)
        if column == "id" or column.endswith("_id"):
            add(column, Reason.MISSING_REQUIRED_ID, _blank(raw))
            add(column, Reason.MALFORMED_ID, ~_blank(raw) & last[column].isNull())
        elif column == "date":
            add(column, Reason.MISSING_DATE, _blank(raw))
            add(column, Reason.INVALID_DATE, ~_blank(raw) & last["year"].isNull())
        elif column == "currency":
            known = last[column].isin(*V.CURRENCY_MAP.values())
            add(column, Reason.MISSING_CURRENCY, last[column].isNull())
            add(column, Reason.AMBIGUOUS_CURRENCY, last[column].isNotNull() & ~known)
        elif column.endswith("price"):
            add(column, Reason.MISSING_PRICE, _blank(raw))
            add(column, Reason.MALFORMED_PRICE, ~_blank(raw) & last[column].isNull())
            add(column, Reason.NON_POSITIVE_PRICE, last[column].try_cast("double") <= 0)
            capped = [c.ops for c in trace.change_points if c.column == column]
            for ops in capped:
                add(column, Reason.SUSPICIOUS_EXTREME_PRICE, F.size(F.col(ops)) > 0)
    return found


def judged_rows(trace: Trace) -> DataFrame:
    """Every row with its final values, its provenance, ``cleaning_status``, ``warning_reason`` and
    ``exclusion_reason``.

    Reasons are ``column:reason`` tags joined by ``;``.  Excluded beats warning, warning
    beats cleaned; a row is cleaned if any operation other than dropping a column changed it.
    """
    hits = [F.when(cond, F.lit(tag)) for cond, tag in _warnings(trace)]
    warning = F.nullif(F.concat_ws(V.LOG_SEPARATOR, *hits), F.lit(""))
    excluded = F.lit(None).cast("string")
    if trace.omit:
        excluded = F.when(F.col(trace.omit), Reason.NO_DISH_ID_AND_NO_PRICE)
    values = [F.col(path).alias(name) for name, path in trace.layouts[-1].items()]
    changed = F.regexp_replace(V.LOG, r"[a-z_]+:column_dropped;?", "") != ""
    named = trace.df.select(
        *values,
        F.col(V.SOURCE_FILE),
        F.col(V.SOURCE_ROW),
        trace.log().alias(V.LOG),
        warning.alias("warning_reason"),
        excluded.alias("exclusion_reason"),
    )
    status = (
        F.when(F.col("exclusion_reason").isNotNull(), Status.EXCLUDED)
        .when(F.col("warning_reason").isNotNull(), Status.WARNING)
        .when(changed, Status.CLEANED)
        .otherwise(Status.OK)
    )
    return named.select(
        *trace.layouts[-1], V.SOURCE_FILE, V.SOURCE_ROW, status.alias("cleaning_status"), "warning_reason", "exclusion_reason"
    )


def row_status(trace: Trace) -> DataFrame:
    """The verdict on every row; see :func:`judged_rows`."""
    return judged_rows(trace).select(
        F.lit(trace.table).alias("table"), V.SOURCE_ROW, "id", "cleaning_status", "warning_reason", "exclusion_reason"
    )
