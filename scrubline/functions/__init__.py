"""Column cleaners (value plus the operations that altered it) and clustering keys."""

from scrubline.functions.cleaners import (
    CURRENCY,
    DATE,
    DECIMAL,
    INT,
    NAME,
    TEXT,
    Cleaner,
    currency_cleaner,
    date_cleaner,
)

__all__ = [
    "CURRENCY",
    "DATE",
    "DECIMAL",
    "INT",
    "NAME",
    "TEXT",
    "Cleaner",
    "currency_cleaner",
    "date_cleaner",
]
