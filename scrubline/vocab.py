"""Table shapes, tags, reasons, maps and limits.

Everything in this module is a constant whose exact value decides a result.
"""

from __future__ import annotations

# --- table shapes (ordered; all text on read) -------------------------------
RAW_COLUMNS = {
    "menu": ("id", "date", "currency", "status"),
    "menu_page": ("id", "menu_id"),
    "menu_item": ("id", "menu_page_id", "price", "high_price", "dish_id"),
    "dish": ("id", "name", "lowest_price", "highest_price"),
}

# --- provenance columns -----------------------------------------------------
SOURCE_FILE = "source_file"
SOURCE_ROW = "source_row_num"
LOG = "log"
OMIT = "omit"
PROVENANCE = (SOURCE_FILE, SOURCE_ROW, OMIT, LOG)
LOG_SEPARATOR = ";"

CHANGE_COLUMNS = (SOURCE_FILE, SOURCE_ROW, "row_id", "column", "before", "after", "operations")
SUMMARY_COLUMNS = ("table", "step", "column", "operation", "rows_affected")


class Op:
    """Operations a cleaner may report."""

    TRIMMED = "trimmed"
    SPACES_COLLAPSED = "spaces_collapsed"
    TO_INT = "to_int"
    TO_DECIMAL_2DP = "to_decimal_2dp"
    WINSORIZED = "winsorized"
    QUOTES_NORMALIZED = "quotes_normalized"
    ACCENTS_FOLDED = "accents_folded"
    UPPERCASED = "uppercased"
    AMPERSAND_EXPANDED = "ampersand_expanded"
    PUNCT_TO_SPACE = "punct_to_space"
    PUNCT_REMOVED = "punct_removed"
    MARKED_UNKNOWN = "marked_unknown"
    DATE_SPLIT = "date_split"
    CURRENCY_MAPPED = "currency_mapped"
    COLUMN_DROPPED = "column_dropped"


class Status:
    """Row verdicts."""

    OK = "ok"
    CLEANED = "cleaned"
    WARNING = "warning"
    EXCLUDED = "excluded"


class Reason:
    """Why a row is warned about or excluded."""

    MISSING_REQUIRED_ID = "missing_required_id"
    MALFORMED_ID = "malformed_id"
    MISSING_DATE = "missing_date"
    INVALID_DATE = "invalid_date"
    MISSING_CURRENCY = "missing_currency"
    AMBIGUOUS_CURRENCY = "ambiguous_currency"
    MISSING_PRICE = "missing_price"
    NON_POSITIVE_PRICE = "non_positive_price"
    MALFORMED_PRICE = "malformed_price"
    NO_VALID_FALLBACK_PRICE = "no_valid_fallback_price"
    NO_DISH_ID_AND_NO_PRICE = "no_dish_id_and_no_price"
    SUSPICIOUS_EXTREME_PRICE = "suspicious_extreme_price"
    PRICE_TOO_LARGE = "price_too_large"


class PriceSource:
    """Which step of the fallback order gave the price."""

    ITEM_PRICE = "menu_item_price"
    ITEM_HIGH_PRICE = "menu_item_high_price"
    DISH_AVERAGE = "dish_lowest_highest_average"
    DISH_LOWEST = "dish_lowest_price"
    DISH_HIGHEST = "dish_highest_price"
    NONE = "no_valid_price"
    ALL = (ITEM_PRICE, ITEM_HIGH_PRICE, DISH_AVERAGE, DISH_LOWEST, DISH_HIGHEST, NONE)


# --- value cleaning ---------------------------------------------------------
NULL_TOKENS = ("", " ", "nan", "NaN", "NAN", "null", "NULL", "None", "\\N", "-", "?")
CURRENCY_MAP = {"Dollars": "USD"}
MIN_PLAUSIBLE_YEAR = 1840
MAX_PLAUSIBLE_YEAR = 2026
WINSORIZE_UPPER_LIMIT = 0.005
WINSORIZE_COLUMNS = {
    "menu_item": ("price", "high_price"),
    "dish": ("lowest_price", "highest_price"),
}
CAP_LIMITS = (0.05, 0.01, 0.005, 0.001)

# --- dish names -------------------------------------------------------------
UNKNOWN_NAME = "UNKNOWN"
NAME_SEPARATORS = "-/():;[]{}<>|\\_~"
NAME_AMPERSAND = " AND "
# Typographic characters and what each becomes, position by position: single and
# double curly quotes, prime, acute, backtick, en dash, em dash, minus, NBSP, ellipsis.
NAME_QUOTES_FROM = "‘’“”′´`–—−\u00a0…"
NAME_QUOTES_TO = "''\"\"'''---  "

# --- validation bands -------------------------------------------------------
CHECK_MIN_YEAR = 1851
CHECK_MAX_YEAR = 2012
CHECK_MAX_LOWEST = 1100
CHECK_MAX_HIGHEST = 3100
CHECK_CURRENCY = "USD"
