"""Expressions on raw passenger-forecast and parking items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelot.functions.time import from_kst

# Provider field of each terminal and direction total.
TOTAL_FIELDS = {
    ("T1", "arrival"): "t1egsum1",
    ("T1", "departure"): "t1dgsum1",
    ("T2", "arrival"): "t2egsum1",
    ("T2", "departure"): "t2dgsum2",
}


def is_summary_row(adate: Column, atime: Column) -> Column:
    """True for the provider's daily-total item."""
    day = F.trim(F.coalesce(adate, F.lit("")))
    hour = F.trim(F.coalesce(atime, F.lit("")))
    return (day != "") & (day == hour) & ~day.rlike(r"^\d+$")


def hour_range(atime: Column) -> tuple[Column, Column]:
    parts = F.split(atime, "_", 2)
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def is_one_hour(atime: Column) -> Column:
    start, end = hour_range(atime)
    one = start.between(0, 23) & ((end == start + 1) | (end == (start + 1) % 24))
    return F.coalesce(one, F.lit(False))


def forecast_hour(adate: Column, atime: Column) -> Column:
    """UTC hour of an item; null when date or hour are malformed."""
    start, _ = hour_range(atime)
    iso = F.regexp_replace(adate, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    day = F.when(adate.rlike(r"^\d{8}$"), iso.try_cast("date"))
    local = day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), start)
    return F.when(is_one_hour(atime), from_kst(local))


def whole_count(text: Column) -> Column:
    """A non-negative whole number written as text, with a zero fraction or exponent or without; null otherwise.

    Plain digits are tested as text, so none is rounded away.
    """
    written = F.trim(text)
    plain = F.when(written.rlike(r"^\+?[0-9]+(\.0*)?$|^-0+(\.0*)?$"), F.regexp_replace(written, r"^[+-]|\..*$", ""))
    scaled = F.when(written.rlike(r"^[0-9.+]+[eE][+-]?[0-9]+$"), written).try_cast("decimal(38,18)")
    return F.coalesce(plain.try_cast("int"), F.when(scaled == F.floor(scaled), scaled.try_cast("int")))


def reading_time(text: Column) -> Column:
    """``yyyyMMddHHmmss.f`` local reading time as UTC; null when malformed."""
    pattern = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})\.(\d{1,6})$"
    iso = F.regexp_replace(text, pattern, "$1-$2-$3 $4:$5:$6.$7")
    return from_kst(F.when(text.rlike(pattern), iso.try_cast("timestamp_ntz")))
