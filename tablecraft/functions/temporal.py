"""Time column expressions.

Hour, day and epoch conversions of zoned timestamps follow the session time
zone; the analyses pin it to UTC (``tablecraft.session.pin_utc``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_bucket(ts) -> Column:
    """Timestamp truncated to the hour, as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(F.date_trunc("hour", _col(ts)), "yyyy-MM-dd HH:mm:ss")


def weekday0(ts) -> Column:
    """Day of week with Monday = 0 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(_col(ts))


def on_day(ts, day: str | dt.date) -> Column:
    """``ts`` falls on calendar day ``day``, written as a range so Parquet can skip."""
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    start = F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{(d + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    c = _col(ts)
    return (c >= start) & (c < end)


def year_month_of_epoch(seconds) -> Column:
    """``yyyy-MM`` of an epoch-seconds column."""
    return F.date_format(F.timestamp_seconds(_col(seconds)), "yyyy-MM")


def hour_of_epoch_millis(ms) -> Column:
    return F.hour(F.timestamp_millis(_col(ms)))
