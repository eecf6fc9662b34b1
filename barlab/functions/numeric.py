"""Money, share and hash expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def money2(value: Column) -> Column:
    """Two decimals, half up, taken from the decimal text of the number and rounded once (FN1). A
    number beyond sixteen digits before the point has none: null."""
    return F.round(value.cast("string").try_cast("decimal(38,20)"), 2).try_cast("decimal(18,2)")


def money_text(value: Column) -> Column:
    """money2 as text; a missing price stays null (FN2)."""
    return money2(value).cast("string")


def hash_of_fields(*fields: Column) -> Column:
    """SHA-256 of the fields joined by '|'; a null field is an empty text (FN3)."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(f, F.lit("")) for f in fields]), 256)


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage of whole; null when whole is 0 (FN5)."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def share_pct_or_zero(part: Column, whole: Column) -> Column:
    """Percentage at two decimals; 0 when whole is 0 (FN5)."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole), 2), F.lit(0.0))
