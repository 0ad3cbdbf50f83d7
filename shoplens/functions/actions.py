"""Scalar rules over user actions, prices, stock, enums and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Learning rate of each action type; any other action counts as 0.
ACTION_ALPHA = {
    "PURCHASE": 0.5,
    "ADD_TO_CART": 0.3,
    "CLICK": 0.3,
    "SEARCH": 0.2,
    "VIEW": 0.1,
    "WISHLIST": 0.1,
}

# Notification days follow the Korean calendar.
NOTIFICATION_ZONE = "Asia/Seoul"

# Patterns of log time stamps, tried in this order.
LOG_TIME_PATTERNS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
]


def action_alpha(action: Column) -> Column:
    """Learning rate of an action, whatever its case."""
    rates = F.create_map(*[F.lit(x) for pair in ACTION_ALPHA.items() for x in pair])
    return F.coalesce(F.try_element_at(rates, F.upper(action)), F.lit(0.0))


def drop_percentage(previous: Column, current: Column) -> Column:
    """Whole percent of a price cut in 32-bit arithmetic, truncated; null where the pair is unusable."""
    ratio = ((previous - current).cast("float") / previous).cast("float")
    usable = previous.isNotNull() & current.isNotNull() & (previous > 0) & (current >= 0)
    return F.when(usable, (ratio * F.lit(100).cast("float")).cast("int"))


def is_price_drop(previous: Column, current: Column, threshold: int = 10) -> Column:
    return F.coalesce(drop_percentage(previous, current) >= threshold, F.lit(False))


def is_restock(previous: Column, current: Column) -> Column:
    return F.coalesce((previous == 0) & (current > 0), F.lit(False))


def notification_day(ts: Column) -> Column:
    """Calendar day of an instant for the daily cap (session time zone is UTC)."""
    return F.to_date(F.from_utc_timestamp(ts, NOTIFICATION_ZONE))


def micros_to_millis(us: Column) -> Column:
    """Integer division, as the reports show whole milliseconds."""
    return F.call_function("div", us, F.lit(1000))


def parse_log_time(text: Column) -> Column:
    """First of the known patterns that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in LOG_TIME_PATTERNS])


def log_severity(level: Column) -> Column:
    return F.when(level == "ERROR", "error").when(level == "WARN", "warning")


def enum_or_default(value: Column, allowed: list[str], default: str) -> Column:
    """`value` if it is one of `allowed`, else `default` (also for null)."""
    return F.when(value.isin(allowed), value).otherwise(F.lit(default))
