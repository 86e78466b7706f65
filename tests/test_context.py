"""Flight and holiday features."""

from datetime import date, timedelta

import pytest

from conftest import at
from frames import context, flight, header, no_context
from tidelot.functions.time import DEFAULT_CUTOFF, cutoff_instant
from tidelot.operators import context as ops

DAY = date(2026, 10, 9)
CUTOFF = cutoff_instant(DAY - timedelta(days=1))
SEEN = CUTOFF - timedelta(minutes=4)
RECORDS = [
    flight(1, 0, "AF1", "202610090905", master="KE1", codeshare="Slave"),
    flight(1, 1, "KE1", "202610090905", terminal="P03"),
    flight(1, 2, "TW1", "20261009093000", terminal="P02", remark="결항"),
    flight(1, 3, "CX1", "202610092310"),
    flight(1, 4, "KE9", "202610090905", remark="CANCELLED"),
]
HEADERS = [header(1, "flights", SEEN, DAY, "arrival"), header(2, "flights", SEEN, DAY, "departure")]


def days(spark):
    return spark.createDataFrame([(DAY,)], "target_date date")


def features(spark, tables):
    rows = ops.context_for_days(tables.headers, tables.flights, tables.holidays, days(spark), DEFAULT_CUTOFF).collect()
    return {(r.terminal, (r.target_hour + timedelta(hours=9)).hour): r for r in rows}


def test_codeshares_terminals_and_cancellations(spark):
    got = features(spark, context(spark, HEADERS, RECORDS))
    assert len(got) == 48
    t1, t2 = got["T1", 9], got["T2", 9]
    assert (t1.flight_arrival, t1.flight_cancelled_arrival) == (0, 2)
    assert (t2.flight_arrival, t2.flight_cancelled_arrival) == (1, 0)
    assert got["T1", 23].flight_arrival == 1 and got["T1", 23].flight_arrival_daily == 1
    assert got["T2", 10].flight_arrival_previous_2h == got["T2", 11].flight_arrival_previous_2h == 1
    assert got["T2", 12].flight_arrival_previous_2h == 0 and got["T2", 0].flight_arrival_previous_2h == 0
    # An empty snapshot says there are none; that is known, not missing.
    assert t1.flight_departure == 0 and t1.flight_departure_available == 1 and t1.flight_departure_next_2h == 0


def test_later_stale_and_missing_snapshots(spark):
    late = header(3, "flights", CUTOFF + timedelta(seconds=1), DAY, "arrival")
    stale = header(4, "flights", CUTOFF - timedelta(hours=12, seconds=1), DAY, "departure")
    edge = header(5, "flights", CUTOFF - timedelta(hours=12), DAY, "arrival")
    actual = header(6, "flights", SEEN, DAY, "departure", basis="actual")
    got = features(spark, context(spark, [late, stale, edge, actual], RECORDS))["T1", 9]
    assert got.flight_arrival_batch_id == 5 and got.flight_arrival == 0
    assert got.flight_departure is None and got.flight_departure_available == 0
    assert got.flight_departure_next_2h is None and got.flight_departure_daily is None


def test_newest_snapshot_wins_by_time_then_id(spark):
    again = header(7, "flights", SEEN, DAY, "arrival")
    got = features(spark, context(spark, [*HEADERS, again], RECORDS))["T2", 9]
    assert got.flight_arrival_batch_id == 7 and got.flight_arrival == 0


@pytest.mark.parametrize("record, reason", [
    (flight(1, 9, "AF2", "202610090905", codeshare="slave"), "codeshare flight without its master"),
    (flight(1, 9, "", "202610090905"), "flight without a number"),
    (flight(1, 9, "X1", "2026100909"), "malformed schedule time"),
    (flight(1, 9, "X1", "202610090905", terminal="P09"), "unknown flight terminal"),
    (flight(1, 9, "X1", "202610100905"), "flight outside its target day"),
])
def test_unusable_records_are_reported(spark, record, reason):
    tables = context(spark, HEADERS, [*RECORDS, record])
    got = ops.flight_problems(tables.headers, tables.flights, DEFAULT_CUTOFF).collect()
    assert [(r.target_date, r.problem) for r in got] == [(DAY, reason)]
    assert all(r.flight_problem == reason for r in features(spark, tables).values())


def test_shadowed_copies_do_not_count_as_broken(spark):
    """Only the kept record of a physical flight needs a known terminal."""
    shadow = flight(1, 9, "AF3", "202610090905", master="KE1", codeshare="Slave", terminal="P09")
    tables = context(spark, HEADERS, [*RECORDS, shadow])
    assert ops.flight_problems(tables.headers, tables.flights, DEFAULT_CUTOFF).count() == 0


def holiday(snapshot, day, flag="Y"):
    return (snapshot, 0, day, flag, "1", "name")


def calendar(spark, day, headers, holidays):
    tables = context(spark, headers, (), holidays)
    return ops.holiday_flags(
        tables.headers, tables.holidays, spark.createDataFrame([(day,)], "target_date date"), DEFAULT_CUTOFF
    ).first()


def test_holiday_neighbours(spark):
    known = header(9, "holidays", at("2026-01-01 00:00:00"), year=2026, month=10)
    got = calendar(spark, DAY, [known], [holiday(9, DAY + timedelta(days=1)), holiday(9, DAY, "N")])
    assert (got.is_holiday, got.holiday_eve, got.day_after_holiday, got.is_day_off) == (0, 1, 0, 0)
    got = calendar(spark, date(2026, 10, 10), [known], [holiday(9, date(2026, 10, 10))])
    assert (got.is_holiday, got.is_day_off, got.holiday_available) == (1, 1, 1)


def test_unknown_month_is_null_but_weekends_are_off(spark):
    next_month = header(9, "holidays", at("2026-01-01 00:00:00"), year=2026, month=11)
    got = calendar(spark, date(2026, 10, 31), [next_month], [holiday(9, date(2026, 11, 1))])
    assert (got.is_holiday, got.holiday_eve, got.day_after_holiday) == (None, 1, None)
    assert (got.is_day_off, got.holiday_available) == (1, 0)


def test_later_calendar_revision_is_not_used(spark):
    old = header(8, "holidays", CUTOFF - timedelta(days=300), year=2026, month=10)
    new = header(9, "holidays", CUTOFF + timedelta(seconds=1), year=2026, month=10)
    got = calendar(spark, DAY, [old, new], [holiday(9, DAY)])
    assert got.is_holiday == 0 and got.holiday_batch_id == 8


def test_without_context(spark):
    got = features(spark, no_context(spark))
    assert len(got) == 48 and all(r.holiday_available == 0 and r.flight_arrival is None for r in got.values())
