"""Date-time text and what follows from it. All times are zone-free."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.functions.text import strip

_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?)?$"
_BARE = _ISO[:-1] + r"\z"  # no line end after it either
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_time(c: Column, stripped: bool = True) -> Column:
    """ISO date-time text, with a blank or ``T`` between; blank or malformed text is NULL."""
    def parsed(text: Column, pattern: str) -> Column:
        padded = (F.when(F.length(text) == 13, F.concat(text, F.lit(":00:00")))
                  .when(F.length(text) == 16, F.concat(text, F.lit(":00"))).otherwise(text))
        return F.when(text.rlike(pattern), padded.try_cast("timestamp_ntz"))

    text = c.cast("string")
    if not stripped:
        return parsed(text, _ISO)
    # stripping costs more than all the rest, and text that is a time already has nothing to strip
    return F.when(text.rlike(_BARE), parsed(text, _BARE)).otherwise(parsed(strip(text), _ISO))


def time_text(c: Column) -> Column:
    return F.date_format(c, TIME_FORMAT)


def as_time(value) -> Column:
    """A literal, a column or a Python datetime as a zone-free time."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def interval(amount: int, unit: str) -> Column:
    return F.expr(f"INTERVAL '{amount}' {unit}")


def infer_sold(ad_expiry: Column, now) -> Column:
    """Gone before its expiry: likely sold. At or after: likely expired. No expiry: unknown."""
    expiry = parse_time(ad_expiry, stripped=False)
    return (F.when(expiry.isNull(), F.lit("unknown"))
            .when(as_time(now) < expiry, F.lit("likely_sold"))
            .otherwise(F.lit("likely_expired")))


def is_decisive(detected: Column) -> Column:
    return detected.isin("available", *fv.GONE_STATUSES)


def decisive_status(detected: Column) -> Column:
    """The public status a decisive outcome stands for; NULL for the others."""
    return (F.when(detected == "available", F.lit("available"))
            .when(detected.isin(*fv.GONE_STATUSES), F.lit("unavailable")))


def kept_status(previous: Column) -> Column:
    """The status that survives an indecisive outcome."""
    return (F.when(previous.isin("available", "unavailable"), previous)
            .otherwise(F.lit("unknown")))


def status_from_detected(detected: Column, previous: Column) -> Column:
    return F.coalesce(decisive_status(detected), kept_status(previous))


def due_for_recheck(first_seen: Column, last_checked: Column, status: Column, now) -> Column:
    """Cadence: daily while fresh, every three days in the first month, then weekly.

    The 14-day rule for unavailable ads counts from the last check.
    """
    now = as_time(now)
    checked = parse_time(last_checked)
    age = now - F.coalesce(parse_time(first_seen), checked)
    elapsed = now - checked
    return (F.when(checked.isNull(), F.lit(True))
            .when((status == "unavailable") & (elapsed > interval(fv.GRAVEYARD_DAYS, "DAY")),
                  F.lit(False))
            .when(age <= interval(fv.FRESH_AGE_DAYS, "DAY"),
                  elapsed >= interval(fv.FRESH_GAP_HOURS, "HOUR"))
            .when(age <= interval(fv.RECENT_AGE_DAYS, "DAY"),
                  elapsed >= interval(fv.RECENT_GAP_DAYS, "DAY"))
            .otherwise(elapsed >= interval(fv.OLD_GAP_DAYS, "DAY")))
