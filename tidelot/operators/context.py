"""Flight and holiday features from the snapshots known at each cutoff.

Snapshots are handled flattened: one header row per snapshot and one row per
record.  A snapshot of any size is then many rows, never one wide row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelot.functions.flights import (
    canonical_flight, flight_cancelled, flight_terminal, is_slave, scheduled_local,
)
from tidelot.functions.lots import DIRECTIONS, TERMINALS
from tidelot.functions.time import cutoff_at, from_kst, span
from tidelot.operators.asof import Channel, asof_lookup
from tidelot.operators.vintages import calendar_grid, day_windows

# Age limit of flight snapshots, columns of records, availability columns.
FLIGHT_MAX_AGE_HOURS = 12
RECORD_COLUMNS = [
    "snapshot_id", "pos", "flight_id", "master_flight_id", "codeshare", "terminal_id", "scheduled_text", "remark",
]
AVAILABILITY = ["holiday_available", "flight_arrival_available", "flight_departure_available"]


def latest_flight_snapshots(headers: DataFrame, cutoff_time: str) -> DataFrame:
    """The newest scheduled snapshot per target day and direction known at its cutoff."""
    cutoff = cutoff_at(F.date_sub("target_date", 1), cutoff_time)
    known = headers.where(
        (F.col("kind") == "flights") & (F.col("time_basis") == "scheduled")
        & (F.col("fetched_at") <= cutoff)
        & (F.col("fetched_at") >= cutoff - span(hours=FLIGHT_MAX_AGE_HOURS))
    )
    return (
        known.groupBy("target_date", "direction")
        .agg(F.max(F.struct("fetched_at", "id")).alias("_s"))
        .select(
            "target_date", "direction",
            F.col("_s.id").alias("snapshot_id"), F.col("_s.fetched_at").alias("fetched_at"),
        )
    )


#: Why a raw flight record cannot be grouped, in the order in which a flight keeps the last of several.
RECORD_PROBLEMS = ["codeshare flight without its master", "flight without a number", "malformed schedule time"]


def record_problem() -> Column:
    """Why a raw flight record cannot be grouped; null when it can."""
    length = F.length(F.coalesce(F.col("scheduled_text"), F.lit("")))
    masterless, numberless, malformed = RECORD_PROBLEMS
    return (
        F.when(
            is_slave(F.col("codeshare")) & (F.coalesce(F.col("master_flight_id"), F.lit("")) == ""),
            masterless,
        )
        .when(canonical_flight(F.col("master_flight_id"), F.col("flight_id")).isNull(), numberless)
        .when(~length.isin(12, 14), malformed)
    )


def problem_code(problem: Column) -> Column:
    """Place of a problem in ``RECORD_PROBLEMS``; null where there is none."""
    return reduce(lambda found, i: found.when(problem == RECORD_PROBLEMS[i], i), range(len(RECORD_PROBLEMS)), F)


def problem_text(code: Column) -> Column:
    return reduce(lambda found, i: found.when(code == i, RECORD_PROBLEMS[i]), range(len(RECORD_PROBLEMS)), F)


def codeshare_collapse(flights: DataFrame, keys: tuple[str, ...] = ("snapshot_id",)) -> DataFrame:
    """One record per physical flight of a snapshot: its master, else its first.

    Plain minima with map-side combine; a popular flight leaves one row per task.
    ``problem`` keeps a reason found on any of its records.
    """
    slave = is_slave(F.col("codeshare")).cast("int")
    return (
        flights.withColumns({
            "flight": canonical_flight(F.col("master_flight_id"), F.col("flight_id")), "problem": record_problem(),
        })
        .groupBy(*keys, "flight", "scheduled_text")
        .agg(
            F.min(F.struct(slave.alias("slave"), "pos", "flight_id", "terminal_id", "remark")).alias("_m"),
            F.max("problem").alias("problem"),
        )
        .select(
            *keys, "flight", "scheduled_text",
            F.col("_m.pos").alias("pos"), F.col("_m.flight_id").alias("flight_id"),
            F.col("_m.terminal_id").alias("terminal_id"), F.col("_m.remark").alias("remark"), "problem",
        )
    )


def flight_hourly_counts(flights: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Operating and cancelled flights per day, direction, terminal and UTC hour.

    ``snapshots`` are the chosen ones; only their records are collapsed.  Rows
    whose records are unusable carry a ``problem`` and count for nothing else.
    """
    day = ["target_date", "direction"]
    records = flights.select(*RECORD_COLUMNS).join(
        snapshots.select("snapshot_id", *day), "snapshot_id"
    )
    # What a physical flight counts for is in its first record, master before slave: packed into one number, its
    # minimum needs no sort, unlike that of a struct.
    terminal = flight_terminal(F.col("terminal_id"))
    place = F.col("pos").cast("long") * 8 + F.when(terminal == TERMINALS[0], 2).when(terminal == TERMINALS[1], 4).otherwise(0)
    first = F.when(is_slave(F.col("codeshare")), F.lit(1 << 40)).otherwise(F.lit(0)) + place + flight_cancelled(F.col("remark")).cast("int")
    physical = records.withColumn("flight", canonical_flight(F.col("master_flight_id"), F.col("flight_id"))).groupBy(
        "snapshot_id", *day, "flight", "scheduled_text").agg(F.min(first).alias("_first"), F.max(problem_code(record_problem())).alias("_problem"))
    counted = physical.select(
        *day, F.substring("scheduled_text", 1, 10).alias("_hour"), "_problem", F.col("_first").bitwiseAND(6).alias("_terminal"),
        (F.col("_first").bitwiseAND(1) == 1).alias("_cancelled"))
    # Times are parsed after counting, once per hour instead of per flight.
    per_hour = (
        counted.groupBy(*day, "_terminal", "_hour", "_problem")
        .agg(F.count_if(~F.col("_cancelled")).alias("_open"), F.count_if(F.col("_cancelled")).alias("_shut"))
        .withColumn("_local", scheduled_local(F.concat("_hour", F.lit("00"))))
        .withColumn("terminal", F.when(F.col("_terminal") == 2, TERMINALS[0]).when(F.col("_terminal") == 4, TERMINALS[1]))
        .withColumn("problem", problem_text(F.col("_problem")))
    )
    problem = F.coalesce(
        F.when(~F.coalesce(F.col("direction").isin(list(DIRECTIONS)), F.lit(False)), "unknown flight direction"),
        F.col("problem"),
        F.when(F.col("terminal").isNull(), "unknown flight terminal")
        .when(F.col("_local").isNull(), "malformed schedule time")
        .when(F.to_date("_local") != F.col("target_date"), "flight outside its target day"),
    )
    return (
        per_hour.groupBy(*day, "terminal", from_kst(F.col("_local")).alias("target_hour"), problem.alias("problem"))
        .agg(F.sum("_open").alias("operating"), F.sum("_shut").alias("cancelled"))
    )


def flight_problems(headers: DataFrame, flights: DataFrame, cutoff_time: str) -> DataFrame:
    """Target days whose chosen snapshots hold unusable records, with one reason."""
    counts = flight_hourly_counts(flights, latest_flight_snapshots(headers, cutoff_time))
    return counts.where("problem is not null").groupBy("target_date").agg(
        F.min("problem").alias("problem"), F.count("*").alias("n")
    )


def flight_day_features(headers: DataFrame, flights: DataFrame, days: DataFrame, cutoff_time: str) -> DataFrame:
    """Flight columns for every day, terminal and hour of ``days(target_date)``.

    No snapshot gives nulls and availability 0; an empty snapshot gives zeros and
    availability 1.  Days, snapshots and counts are unioned on the hour grid and
    aggregated once instead of being joined.  ``flight_problem`` is set on all
    rows of a day with unusable records.
    """
    chosen = latest_flight_snapshots(headers, cutoff_time)
    counts = flight_hourly_counts(flights, chosen)
    hour = ["target_date", "terminal", "target_hour"]
    grid = calendar_grid(days.select("target_date"), "target_date", directions=False).withColumn("_asked", F.lit(True))
    status = calendar_grid(chosen, "target_date", ["direction", "snapshot_id", "fetched_at"], directions=False)
    stacked = grid.unionByName(status, allowMissingColumns=True).unionByName(counts, allowMissingColumns=True)

    def of(direction: str, column: str, pick=F.max):
        return pick(F.when(F.col("direction") == direction, F.col(column)))

    hours = stacked.groupBy(*hour).agg(
        F.max("_asked").alias("_asked"), F.max("problem").alias("_problem"),
        *[of(d, c).alias(f"flight_{d}_{n}") for d in DIRECTIONS
          for c, n in (("snapshot_id", "batch_id"), ("fetched_at", "fetched_at"))],
        *[of(d, c, F.sum).alias(f"_{n}_{d}") for d in DIRECTIONS
          for c, n in (("operating", "open"), ("cancelled", "shut"))],
    )
    known = {d: F.col(f"flight_{d}_batch_id").isNotNull() for d in DIRECTIONS}

    def when_known(direction: str, value: Column) -> Column:
        return F.when(known[direction], F.coalesce(value, F.lit(0)))

    filled = hours.select(
        *hour, "_asked", F.max("_problem").over(Window.partitionBy("target_date")).alias("flight_problem"),
        *[known[d].cast("int").alias(f"flight_{d}_available") for d in DIRECTIONS],
        *[F.col(f"flight_{d}_{c}") for d in DIRECTIONS for c in ("batch_id", "fetched_at")],
        *[when_known(d, F.col(f"_open_{d}")).alias(f"flight_{d}") for d in DIRECTIONS],
        *[when_known(d, F.col(f"_shut_{d}")).alias(f"flight_cancelled_{d}") for d in DIRECTIONS],
    ).where("_asked").drop("_asked")
    windows = day_windows(filled, "target_date", "flight_arrival", "flight_departure", "flight_")
    return windows.withColumns({
        "flight_arrival_previous_2h": when_known("arrival", F.col("flight_arrival_previous_2h")),
        "flight_departure_next_2h": when_known("departure", F.col("flight_departure_next_2h")),
    })


def latest_calendars(headers: DataFrame, asked: DataFrame) -> DataFrame:
    """The newest calendar snapshot of a month known at each instant.

    ``asked`` has ``year``, ``month`` and ``cutoff_at``; calendars never expire.
    A month's group holds its snapshot headers and about a month of cutoffs.
    """
    history = headers.where(F.col("kind") == "holidays").select("year", "month", "fetched_at", "id")
    channel = Channel("calendar", "id", ("id", "fetched_at"))
    found = asof_lookup(
        asked, history, keys=["year", "month"], query_time="cutoff_at", history_time="fetched_at",
        tie="id", channels=[channel], bucket=None,
    )
    return found.select(
        "year", "month", F.col("at").alias("cutoff_at"),
        F.col("calendar.id").alias("snapshot_id"), F.col("calendar.fetched_at").alias("fetched_at"),
    )


def holiday_flags(headers: DataFrame, holidays: DataFrame, days: DataFrame, cutoff_time: str) -> DataFrame:
    """Holiday columns of each ``days(target_date)``, as known at the day-before cutoff.

    The eve and day-after flags come from the calendars of the neighbouring days'
    own months; a month without a known calendar gives null.
    """
    roles = {"is_holiday": 0, "holiday_eve": 1, "day_after_holiday": -1}
    asked = days.select(
        "target_date", cutoff_at(F.date_sub("target_date", 1), cutoff_time).alias("cutoff_at"),
        F.explode(
            F.array(*[
                F.struct(F.lit(role).alias("role"), F.date_add("target_date", shift).alias("day"))
                for role, shift in roles.items()
            ])
        ).alias("_r"),
    ).select(
        "target_date", "cutoff_at", "_r.role", "_r.day",
        F.year("_r.day").alias("year"), F.month("_r.day").alias("month"),
    )
    found = asked.join(latest_calendars(headers, asked), ["year", "month", "cutoff_at"], "left")
    marked = (
        holidays.where("is_holiday = 'Y'").select("snapshot_id", F.col("locdate").alias("day")).distinct()
        .withColumn("_y", F.lit(1))
    )
    flags = found.join(marked, ["snapshot_id", "day"], "left").withColumn(
        "_flag", F.when(F.col("snapshot_id").isNotNull(), F.coalesce("_y", F.lit(0)))
    )
    own = F.col("role") == "is_holiday"
    wide = flags.groupBy("target_date").agg(
        *[F.max(F.when(F.col("role") == role, F.col("_flag"))).alias(role) for role in roles],
        F.max(F.when(own, F.col("snapshot_id"))).alias("holiday_batch_id"),
        F.max(F.when(own, F.col("fetched_at"))).alias("holiday_fetched_at"),
    )
    return wide.select(
        "target_date", *roles,
        F.when(F.weekday("target_date") >= 5, F.lit(1)).otherwise(F.col("is_holiday")).alias("is_day_off"),
        F.col("holiday_batch_id").isNotNull().cast("int").alias("holiday_available"),
        "holiday_batch_id", "holiday_fetched_at",
    )


def context_for_days(
    headers: DataFrame, flights: DataFrame, holidays: DataFrame, days: DataFrame, cutoff_time: str
) -> DataFrame:
    """Flight and holiday features by (target_date, terminal, target_hour)."""
    by_hour = flight_day_features(headers, flights, days, cutoff_time)
    return by_hour.join(holiday_flags(headers, holidays, days, cutoff_time), "target_date", "left")


def context_coverage(frame: DataFrame) -> DataFrame:
    """Rows on which each kind of context was available."""
    flags = F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in AVAILABILITY if n in frame.columns
    ])
    return frame.select(F.explode(flags).alias("_f")).groupBy(F.col("_f.name").alias("name")).agg(
        F.count_if(F.col("_f.value") == 1).alias("available_rows"), F.count("*").alias("total_rows")
    )
