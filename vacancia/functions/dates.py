"""Dates arrive as text in several shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

_ISO = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+\-]\d{2}:?\d{2})?)?$"


def dmy_to_iso(raw: Column) -> Column:
    """DD/MM/YYYY to ISO; blank to null; anything else unchanged."""
    day = F.date_format(F.try_to_date(raw, "d/M/yyyy"), "yyyy-MM-dd")
    return F.coalesce(day, F.nullif(raw, F.lit("")))


def epoch_ms_to_date(ms: Column) -> Column:
    """Epoch milliseconds to an ISO day in UTC; 0 and null stay unknown."""
    known = F.nullif(ms.try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.date_format(F.timestamp_millis(known), "yyyy-MM-dd")


def parse_iso(raw: Column) -> Column:
    """ISO day (midnight UTC) or ISO timestamp (UTC unless it names an offset); else null."""
    text = strip(raw)
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def since(raw: Column, days: int, as_of: Column) -> Column:
    """Recency filter: unknown and unreadable dates are kept."""
    ts = parse_iso(raw)
    return ts.isNull() | (ts >= as_of - F.make_dt_interval(days=F.lit(days)))


def fresh_until(raw: Column, days: int, as_of: Column) -> Column:
    """Freshness test: unknown and unreadable dates are refused."""
    ts = parse_iso(raw)
    return F.coalesce(ts >= as_of - F.make_dt_interval(days=F.lit(days)), F.lit(False))


def time_stamp(now: Column | None = None) -> Column:
    """A point in time as records store it; the job's own time by default."""
    return F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
