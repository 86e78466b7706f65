"""Small input frames for the tests."""

from datetime import date, datetime, timedelta

from tidelot import schemas
from tidelot.plans.nextday import Context

LOT = "T1 장기 P1 주차장"


def parking(spark, rows, lot=LOT, delay=timedelta(seconds=30)):
    """Readings from (observed_at, occupied[, total[, collected_at]]) tuples."""
    out = []
    for i, row in enumerate(rows):
        seen, occupied, *rest = row
        total = rest[0] if rest else 100
        known = rest[1] if len(rest) > 1 else seen + delay
        out.append((i + 1, "test", lot, seen, known, occupied, total))
    return spark.createDataFrame(out, schemas.PARKING)


def every_ten(start: datetime, count: int, occupied):
    return [(start + timedelta(minutes=10 * i), occupied(i)) for i in range(count)]


def batch(spark, day: date, batch_id=1, value=100, fetched=None, drop=0, **changes):
    """A complete day-ahead batch of 96 rows for a local ``day``."""
    fetched = fetched or datetime.combine(day, datetime.min.time()) - timedelta(days=1) + timedelta(hours=8, minutes=10, seconds=10)
    start = datetime.combine(day, datetime.min.time()) - timedelta(hours=9)
    rows = [
        (batch_id, "test", fetched, day, 1, "baseline", 96, start + timedelta(hours=h), t, d,
         changes.get(f"{t}_{d}_{h}", value))
        for h in range(24) for t in ("T1", "T2") for d in ("arrival", "departure")
    ]
    return spark.createDataFrame(rows[: len(rows) - drop], schemas.PASSENGERS)


def no_context(spark):
    return Context(*[
        spark.createDataFrame([], s) for s in (schemas.CONTEXT_HEADERS, schemas.FLIGHTS, schemas.HOLIDAYS)
    ])


def header(spark_id, kind, fetched, day=None, direction=None, basis="scheduled", year=None, month=None):
    return (spark_id, "test", kind, fetched, day, direction, basis if kind == "flights" else None, year, month)


def flight(snapshot, pos, number, when, terminal="P01", master="", codeshare="Master", remark=""):
    return (snapshot, pos, f"fid{snapshot}-{pos}", number, master, codeshare, terminal, when, remark)


def context(spark, headers, flights=(), holidays=()):
    return Context(
        spark.createDataFrame(list(headers), schemas.CONTEXT_HEADERS),
        spark.createDataFrame(list(flights), schemas.FLIGHTS),
        spark.createDataFrame(list(holidays), schemas.HOLIDAYS),
    )
