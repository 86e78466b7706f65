"""Expressions on flight records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Concourse code to terminal.
CONCOURSE_TERMINAL = {"P01": "T1", "P02": "T1", "P03": "T2"}


def flight_terminal(code: Column) -> Column:
    chain = None
    for concourse, terminal in CONCOURSE_TERMINAL.items():
        chain = (F if chain is None else chain).when(code == concourse, terminal)
    return chain


def flight_cancelled(remark: Column) -> Column:
    text = F.coalesce(remark, F.lit(""))
    return text.contains("결항") | F.lower(text).contains("cancel")


def is_slave(codeshare: Column) -> Column:
    return F.lower(F.coalesce(codeshare, F.lit(""))) == "slave"


def canonical_flight(master: Column, flight: Column) -> Column:
    """The physical flight's number; null when the record names none."""
    return F.coalesce(F.nullif(master, F.lit("")), F.nullif(flight, F.lit("")))


def scheduled_local(text: Column) -> Column:
    """``yyyyMMddHHmm[ss]`` as local wall time; null when it is not one."""
    pattern = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})?$"
    padded = F.rpad(text, 14, "0")
    iso = F.regexp_replace(padded, pattern, "$1-$2-$3 $4:$5:$6")
    return F.when(text.rlike(pattern), iso.try_cast("timestamp_ntz"))
