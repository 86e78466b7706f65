"""Zone-free time expressions on ``timestamp_ntz`` columns that hold UTC.

Korea has kept a fixed +9 h offset since 1988, so local wall time is an interval
addition.  Nothing here depends on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KST_HOURS = 9
DEFAULT_CUTOFF = "17:15"


def span(*, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    """A constant day-time interval."""
    return F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes))


def to_kst(ts: Column) -> Column:
    return ts + span(hours=KST_HOURS)


def from_kst(ts: Column) -> Column:
    return ts - span(hours=KST_HOURS)


def kst_date(ts: Column) -> Column:
    return F.to_date(to_kst(ts))


def day_start_utc(day: Column) -> Column:
    """UTC instant at which a local day begins."""
    return from_kst(day.cast("timestamp_ntz"))


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3_600_000_000.0)


def with_floor(df: DataFrame, ts: str, name: str, width: str) -> DataFrame:
    """Add ``ts`` rounded down to a multiple of ``width`` (rows need a time)."""
    return df.withColumn(name, F.window(F.col(ts), width).start)


def cutoff_minutes(cutoff_time: str) -> int:
    hour, minute = (int(part) for part in cutoff_time.split(":"))
    return hour * 60 + minute


def cutoff_at(day: Column, cutoff_time: str = DEFAULT_CUTOFF) -> Column:
    """UTC instant of a local wall-clock cutoff on ``day``."""
    return day_start_utc(day) + span(minutes=cutoff_minutes(cutoff_time))


def first_issue(visible: Column, cutoff_time: str = DEFAULT_CUTOFF) -> Column:
    """The first local day whose cutoff is not before ``visible``."""
    local = to_kst(visible) - span(minutes=cutoff_minutes(cutoff_time))
    day = F.to_date(local)
    return F.when(day.cast("timestamp_ntz") == local, day).otherwise(F.date_add(day, 1))


def cutoff_instant(day: date, cutoff_time: str = DEFAULT_CUTOFF) -> datetime:
    """The same cutoff as a driver-side naive UTC value."""
    start = datetime.combine(day, datetime.min.time()) - timedelta(hours=KST_HOURS)
    return start + timedelta(minutes=cutoff_minutes(cutoff_time))


def instant(value: datetime) -> Column:
    """A naive UTC ``datetime`` as a ``timestamp_ntz`` literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


EPOCH = "1970-01-01 00:00:00"


def to_instant(ts: Column) -> Column:
    """The UTC reading as a ``timestamp``, which watermarks need; zone-free."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), ts))


def from_instant(ts: Column) -> Column:
    """A ``timestamp`` as its UTC reading; zone-free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit(EPOCH).cast("timestamp_ntz"))


def parse_offset_timestamp(text: Column) -> Column:
    """ISO text that carries an offset, as UTC; independent of the session zone."""
    return from_instant(text.cast("timestamp"))


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def local_calendar(ts: Column, *, whole_hour: bool) -> dict[str, Column]:
    """Hour and weekday cycles of a UTC time in local wall time (Monday is 0)."""
    local = to_kst(ts)
    hour = F.hour(local).cast("double")
    if not whole_hour:
        hour = hour + F.minute(local) / F.lit(60.0)
    weekday = F.weekday(local)
    hour_sin, hour_cos = cyclic(hour, 24)
    weekday_sin, weekday_cos = cyclic(weekday, 7)
    return {
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "weekday_sin": weekday_sin,
        "weekday_cos": weekday_cos,
        "is_weekend": (weekday >= 5).cast("int"),
    }
