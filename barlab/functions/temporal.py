"""Date and timestamp expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# The exchange's wall clock and the hour after which a session counts as closed.
EXCHANGE_ZONE = "+05:30"
SESSION_CLOSE_HOUR = 18

# Month-name date layouts found in index announcements.
RELEASE_DATE_LAYOUTS = ("MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy")


def exchange_wall_time(text: Column) -> Column:
    """Text with an offset is moved to exchange time; text without one already is (FN8)."""
    has_offset = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    stamp = F.try_to_timestamp(text).cast("timestamp_ntz")
    return F.when(has_offset, F.convert_timezone(None, F.lit(EXCHANGE_ZONE), stamp)).otherwise(stamp)


def expected_session(now: Column, close_hour: int = SESSION_CLOSE_HOUR) -> Column:
    """Most recent Monday-to-Friday date whose close has passed (CAL3)."""
    day = F.to_date(now - F.expr(f"interval {int(close_hour)} hours"))
    weekday = F.dayofweek(day)
    return F.when(weekday == 1, F.date_sub(day, 2)).when(weekday == 7, F.date_sub(day, 1)).otherwise(day)


def release_date_text(text: Column) -> Column:
    """Strip ordinals, commas and dots, then try each month-name layout (FN9)."""
    plain = F.regexp_replace(text, r"(\d)(st|nd|rd|th)", "$1")
    plain = F.trim(F.regexp_replace(F.regexp_replace(plain, r"[,.]", " "), r"(?U)\s+", " "))
    plain = F.initcap(plain)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(plain, F.lit(layout))) for layout in RELEASE_DATE_LAYOUTS])
