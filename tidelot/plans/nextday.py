"""Next-day hourly feature frame, for one issue day or all of them at once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelot.functions.lots import lot_terminal_strict, lot_type, occupancy_ratio
from tidelot.functions.time import (
    DEFAULT_CUTOFF, KST_HOURS, cutoff_at, cutoff_instant, first_issue, hours_between, instant, kst_date, local_calendar,
    minutes_between,
)
from tidelot.operators.context import (
    context_for_days, flight_problems,
)
from tidelot.operators.summaries import summary_anchors, summary_history
from tidelot.operators.truth import MINIMUM_SLOTS, hourly_truth, same_hour_history
from tidelot.operators.vintages import WINDOW_MINUTES, forecast_batches, passenger_day_features

ANCHOR_MAX_AGE_MINUTES = 20
#: Local days before a target day whose readings its history looks at.
HISTORY_DAYS = 8

# Feature lists, in model order.
CATEGORICAL = ["lot_name", "terminal", "lot_type"]
BASE_NUMERIC = [
    "current_ratio", "current_capacity", "anchor_age_minutes", "lead_hours",
    "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "is_weekend",
    "previous_day_same_hour", "previous_week_same_hour",
    "previous_day_max", "previous_day_min", "previous_week_max", "previous_week_min",
    "arrival", "departure", "arrival_previous_2h", "departure_next_2h",
    "arrival_cumulative", "departure_cumulative", "arrival_daily", "departure_daily",
]
CONTEXT_NUMERIC = [
    "is_holiday", "holiday_eve", "day_after_holiday", "is_day_off", "holiday_available",
    "flight_arrival_available", "flight_departure_available",
    "flight_arrival", "flight_departure", "flight_cancelled_arrival", "flight_cancelled_departure",
    "flight_arrival_previous_2h", "flight_departure_next_2h",
    "flight_arrival_cumulative", "flight_departure_cumulative",
    "flight_arrival_daily", "flight_departure_daily",
]


@dataclass(frozen=True)
class Context:
    """Flattened context snapshots: headers, flight records, holiday records."""

    headers: DataFrame
    flights: DataFrame
    holidays: DataFrame


def issue_range(issues: DataFrame) -> tuple[date, date] | None:
    """First and last day of ``issues``; two dates reach the driver, so that scans can be cut to them."""
    low, high = issues.agg(F.min("issue_date"), F.max("issue_date")).first()
    return None if low is None else (low, high)


def known_readings(parking: DataFrame, days: tuple[date, date] | None, cutoff_time: str) -> DataFrame:
    """Readings visible at the last cutoff; an anchor may be as old as it likes."""
    if days is None:
        return parking.where(F.lit(False))
    last = instant(cutoff_instant(days[1], cutoff_time))
    return parking.where((F.col("collected_at") <= last) & (F.col("observed_at") <= last))


def _local_days(rows: DataFrame, name: str, days: tuple[date, date] | None, first: int, end: int) -> DataFrame:
    """Rows whose time ``name`` is on the local days from ``first`` days after the first issue to before ``end`` after the last."""
    if days is None:
        return rows.where(F.lit(False))
    start, stop = (datetime.combine(d + timedelta(days=n), time.min) - timedelta(hours=KST_HOURS)
                   for d, n in zip(days, (first, end), strict=True))
    return rows.where((F.col(name) >= instant(start)) & (F.col(name) < instant(stop)))


def history_readings(parking: DataFrame, days: tuple[date, date] | None) -> DataFrame:
    """Readings of the local days that the same hours of the day and the week before can lie on."""
    return _local_days(parking, "observed_at", days, 1 - HISTORY_DAYS, 2)


def history_hours(summary: DataFrame, days: tuple[date, date] | None) -> DataFrame:
    """The same of summary rows."""
    return _local_days(summary, "target_hour", days, 1 - HISTORY_DAYS, 2)


def day_forecasts(passengers: DataFrame, days: tuple[date, date] | None) -> DataFrame:
    """Forecasts for the days after the issues; a batch is judged and read day by day."""
    return _local_days(passengers, "target_hour", days, 1, 2)


def known_anchors(parking: DataFrame, issues: DataFrame, days: tuple[date, date] | None, cutoff_time: str,
                  summary: DataFrame | None) -> DataFrame:
    """:func:`latest_anchors` from a summary where one is kept, else from the readings visible at the last cutoff."""
    if summary is None:
        return latest_anchors(known_readings(parking, days, cutoff_time), issues, cutoff_time)
    known = summary.where(F.lit(False)) if days is None else summary.where(F.col("known_from") <= F.lit(days[1]))
    return carried_anchors(summary_anchors(known), issues)


def target_readings(parking: DataFrame, predictions: DataFrame) -> DataFrame:
    """Readings of the hours that were predicted, from the first to the last."""
    first, last = predictions.agg(F.min("target_hour"), F.max("target_hour")).first()
    if first is None:
        return parking.where(F.lit(False))
    return parking.where(
        (F.col("observed_at") >= instant(first)) & (F.col("observed_at") < instant(last + timedelta(hours=1))))


def day_headers(headers: DataFrame, days: tuple[date, date] | None) -> DataFrame:
    """Holiday headers, and flight headers of the target days."""
    if days is None:
        return headers.where(F.lit(False))
    first, last = (F.lit(d + timedelta(days=1)) for d in days)
    return headers.where((F.col("kind") != "flights") | F.col("target_date").between(first, last))


def latest_anchors(parking: DataFrame, issues: DataFrame, cutoff_time: str = DEFAULT_CUTOFF) -> DataFrame:
    """The last visible reading of every lot at each cutoff of ``issues(issue_date)``.

    A reading enters the first cutoff at or after it became visible; one partial
    maximum per (lot, issue day) is then carried over the days, so the window
    holds days, not readings.  Closed winners are kept here.
    """
    visible = F.greatest("collected_at", "observed_at")
    reading = F.struct("collected_at", "observed_at", "occupied_spaces", "total_spaces")
    per_day = parking.groupBy("lot_name", first_issue(visible, cutoff_time).alias("known_from")).agg(F.max(reading).alias("latest"))
    return carried_anchors(per_day, issues)


def carried_anchors(per_day: DataFrame, issues: DataFrame) -> DataFrame:
    """The anchors of ``issues`` from ``(lot_name, known_from, latest)``, the latest reading each day is the first to see."""
    per_day = per_day.select("lot_name", F.col("known_from").alias("_from"), F.col("latest").alias("_r"))
    by_day = Window.partitionBy("lot_name").orderBy("_from")
    last_issue = issues.agg(F.max("issue_date").alias("d")).scalar()
    best = F.max("_r").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = per_day.select(
        "lot_name", "_from", best.alias("_r"),
        F.coalesce(F.date_sub(F.lead("_from").over(by_day), 1), last_issue).alias("_until"),
    ).where("_from <= _until").select(
        "lot_name", "_from", "_until",
        F.col("_r.collected_at").alias("anchor_collected_at"),
        F.col("_r.observed_at").alias("anchor_observed_at"),
        F.col("_r.occupied_spaces").alias("occupied_spaces"),
        F.col("_r.total_spaces").alias("total_spaces"),
    )
    daily = carried.withColumn("issue_date", F.explode(F.sequence("_from", "_until"))).drop("_from", "_until")
    return daily.join(issues.select("issue_date"), "issue_date", "left_semi")


def issue_days(passengers: DataFrame) -> DataFrame:
    """Every day before a forecast target day."""
    return passengers.select(F.date_sub(kst_date(F.col("target_hour")), 1).alias("issue_date")).distinct()


def anchor_rows(anchors: DataFrame, cutoff_time: str) -> DataFrame:
    """Open anchors with the columns that do not depend on the target hour."""
    return anchors.where("total_spaces > 0").select(
        "issue_date", F.date_add("issue_date", 1).alias("target_date"),
        cutoff_at(F.col("issue_date"), cutoff_time).alias("origin_at"),
        "lot_name",
        lot_terminal_strict(F.col("lot_name")).alias("terminal"),
        lot_type(F.col("lot_name")).alias("lot_type"),
        occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces")).alias("current_ratio"),
        F.col("total_spaces").alias("current_capacity"),
        "anchor_observed_at", "anchor_collected_at",
    ).withColumn("anchor_age_minutes", minutes_between(F.col("anchor_observed_at"), F.col("origin_at")))


def build_days(
    parking: DataFrame,
    passengers: DataFrame,
    context: Context,
    issues: DataFrame,
    cutoff_time: str = DEFAULT_CUTOFF,
    window_minutes: int | None = WINDOW_MINUTES,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Feature rows (lot by target hour) for all ``issues(issue_date)`` in one plan.

    With a kept ``summary`` of the readings (:mod:`tidelot.operators.summaries`) anchors and history come from it, and no
    reading is scanned.

    Days without a complete batch or an open anchor, with a lot of unknown
    terminal, or with unusable flight records give no rows; ``skipped_days``
    tells why.
    """
    span_of_days = issue_range(issues)
    days = issues.select(F.date_add("issue_date", 1).alias("target_date"))
    found = known_anchors(parking, issues, span_of_days, cutoff_time, summary)
    anchors = anchor_rows(found, cutoff_time)
    unmapped = F.bool_or(F.col("terminal").isNull()).over(Window.partitionBy("issue_date"))
    anchors = anchors.withColumn("_unmapped", unmapped).where("not _unmapped").drop("_unmapped")
    hours = passenger_day_features(day_forecasts(passengers, span_of_days), cutoff_time, window_minutes)
    rows = anchors.join(hours, ["target_date", "terminal"])
    rows = rows.withColumns({
        "lead_hours": hours_between(F.col("origin_at"), F.col("target_hour")),
        **local_calendar(F.col("target_hour"), whole_hour=True),
    })
    headers = day_headers(context.headers, span_of_days)
    known = context_for_days(headers, context.flights, context.holidays, days, cutoff_time)
    usable = known.where("flight_problem is null").drop("flight_problem")
    if summary is None:
        history = same_hour_history(history_readings(parking, span_of_days), cutoff_time)
    else:
        history = summary_history(history_hours(summary, span_of_days), cutoff_time)
    return rows.join(usable, ["target_date", "terminal", "target_hour"]).join(history, ["lot_name", "target_hour"], "left")


def skipped_days(
    parking: DataFrame,
    passengers: DataFrame,
    context: Context,
    issues: DataFrame,
    cutoff_time: str = DEFAULT_CUTOFF,
    window_minutes: int | None = WINDOW_MINUTES,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Issue days that cannot be built and the first reason why."""
    days = issue_range(issues)
    batches = forecast_batches(day_forecasts(passengers, days), cutoff_time, window_minutes).select(
        F.date_sub("target_date", 1).alias("issue_date"), F.lit(True).alias("_batch")
    )
    broken = flight_problems(day_headers(context.headers, days), context.flights, cutoff_time).select(
        F.date_sub("target_date", 1).alias("issue_date"), F.col("problem").alias("_flight")
    )
    anchors = known_anchors(parking, issues, days, cutoff_time, summary).where("total_spaces > 0")
    per_day = anchors.groupBy("issue_date").agg(
        F.count("*").alias("_anchors"),
        F.min(F.when(lot_terminal_strict(F.col("lot_name")).isNull(), F.col("lot_name"))).alias("_unmapped"),
    )
    reason = (
        F.when(F.col("_batch").isNull(), F.lit("no complete day-ahead passenger batch"))
        .when(F.col("_flight").isNotNull(), F.col("_flight"))
        .when(F.col("_anchors").isNull(), F.lit("no parking observations at the cutoff"))
        .when(F.col("_unmapped").isNotNull(), F.concat(F.lit("lot without a terminal: "), F.col("_unmapped")))
    )
    return (
        issues.select("issue_date")
        .join(batches, "issue_date", "left").join(broken, "issue_date", "left").join(per_day, "issue_date", "left")
        .select(F.date_add("issue_date", 1).alias("target_date"), reason.alias("reason"))
        .where("reason is not null")
    )


def join_truth(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Left join on (lot, hour); both sides hold one row per lot and hour of a target day."""
    return rows.join(truth, ["lot_name", "target_hour"], "left")


def training_row_filter(rows: DataFrame) -> DataFrame:
    """Rows with a recent anchor and a label."""
    return rows.where(
        (F.col("anchor_age_minutes") <= ANCHOR_MAX_AGE_MINUTES) & F.col("actual_ratio").isNotNull()
    )


def past_issues(passengers: DataFrame, as_of: Column, cutoff_time: str = DEFAULT_CUTOFF) -> DataFrame:
    return issue_days(passengers).where(cutoff_at(F.col("issue_date"), cutoff_time) < as_of)


def build_training(
    parking: DataFrame,
    passengers: DataFrame,
    context: Context,
    as_of: Column,
    cutoff_time: str = DEFAULT_CUTOFF,
    minimum_slots: int = MINIMUM_SLOTS,
    summary: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Labelled rows of every issue before ``as_of``, and the skipped days.

    ``summary`` serves anchors and history; the labels of an ``as_of`` between two cutoffs need the readings.

    ``minimum_slots`` affects labels only; history features keep the default.
    """
    issues = past_issues(passengers, as_of, cutoff_time)
    skipped = skipped_days(parking, passengers, context, issues, cutoff_time, summary=summary)
    rows = build_days(parking, passengers, context, issues, cutoff_time, summary=summary)
    truth = hourly_truth(parking, as_of, minimum_slots, deduplicate=False)
    return training_row_filter(join_truth(rows, truth)), skipped
