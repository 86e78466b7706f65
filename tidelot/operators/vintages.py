"""Forecast vintages: batch completeness, revisions and day features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelot.functions.lots import DIRECTIONS, TERMINALS
from tidelot.functions.time import cutoff_at, kst_date, span, to_kst

BATCH_KEYS = 96
KEY = ["target_hour", "terminal", "direction"]
WINDOW_MINUTES = 5


def calendar_grid(
    days: DataFrame, day: str, keep: list[str] | None = None, *, directions: bool = True
) -> DataFrame:
    """The 24 local hours of each row's day for every terminal (and direction)."""
    others = keep or []
    grid = days.select(day, *others, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h")).select(
        day, *others,
        (F.col(day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_h") - 9)).alias("target_hour"),
        F.explode(F.array(*[F.lit(t) for t in TERMINALS])).alias("terminal"),
    )
    if directions:
        grid = grid.select("*", F.explode(F.array(*[F.lit(d) for d in DIRECTIONS])).alias("direction"))
    return grid


def _grid_bits(terminal: str) -> Column:
    """One bit per (local hour, direction) of a terminal; null off the grid."""
    local = to_kst(F.col("target_hour"))
    aligned = (F.minute(local) == 0) & (F.second(local) == 0) & (
        F.col("target_hour") == F.to_date(local).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(local) - 9)
    )
    place = F.when(F.col("direction") == DIRECTIONS[0], F.hour(local)).when(
        F.col("direction") == DIRECTIONS[1], F.hour(local) + 24
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return F.when(aligned & (F.col("terminal") == terminal) & place.isNotNull(), bit)


def batch_summary(passengers: DataFrame) -> DataFrame:
    """Per batch and local target day: rows, fetch time and grid completeness.

    Completeness is counted with bit masks, so it is one map-side aggregation and
    needs no distinct pass.
    """
    masks = [F.coalesce(F.bit_count(F.bit_or(_grid_bits(t))), F.lit(0)) for t in TERMINALS]
    on_grid = reduce(lambda a, b: a | b, [_grid_bits(t).isNotNull() for t in TERMINALS])
    keys = reduce(lambda a, b: a + b, masks)
    return (
        passengers.withColumn("target_date", kst_date(F.col("target_hour")))
        .groupBy("target_date", "batch_id")
        .agg(
            F.count("*").alias("rows"),
            keys.cast("int").alias("keys"),
            F.count_if(~F.coalesce(on_grid, F.lit(False))).alias("off_grid"),
            F.min("fetched_at").alias("fetched_at"),
            F.max("fetched_at").alias("_last_fetched_at"),
        )
        .select(
            "target_date", "batch_id", "rows", "keys", "fetched_at",
            (
                (F.col("rows") == BATCH_KEYS) & (F.col("keys") == BATCH_KEYS) & (F.col("off_grid") == 0)
                & (F.col("fetched_at") == F.col("_last_fetched_at"))
            ).alias("is_complete"),
        )
    )


def batch_window_filter(
    passengers: DataFrame, cutoff_time: str, window_minutes: int | None = WINDOW_MINUTES
) -> DataFrame:
    """Day-ahead rows fetched by the cutoff of the day before their target day.

    With ``window_minutes`` the fetch must also lie in the last minutes before
    the cutoff, both ends included.
    """
    cutoff = cutoff_at(F.date_sub(kst_date(F.col("target_hour")), 1), cutoff_time)
    known = passengers.where(F.col("fetched_at") <= cutoff)
    if "day_offset" in passengers.columns:
        known = known.where("day_offset = 1")
    if window_minutes is not None:
        known = known.where(F.col("fetched_at") >= cutoff - span(minutes=window_minutes))
    return known


def forecast_batches(
    passengers: DataFrame, cutoff_time: str, window_minutes: int | None = WINDOW_MINUTES
) -> DataFrame:
    """The newest complete day-ahead batch of each target day known at its cutoff.

    Equal fetch times are settled by the larger batch id.
    """
    candidates = batch_summary(batch_window_filter(passengers, cutoff_time, window_minutes))
    return (
        candidates.where("is_complete")
        .groupBy("target_date")
        .agg(F.max(F.struct("fetched_at", "batch_id")).alias("_best"))
        .select(
            "target_date",
            F.col("_best.batch_id").alias("forecast_batch_id"),
            F.col("_best.fetched_at").alias("forecast_fetched_at"),
        )
    )


def key_set_equal(passengers: DataFrame) -> DataFrame:
    """Per batch and target day: keys missing from the grid and keys beyond it."""
    return batch_summary(passengers).select(
        "target_date", "batch_id",
        (F.lit(BATCH_KEYS) - F.col("keys")).alias("missing_keys"),
        (F.col("rows") - F.col("keys")).alias("extra_rows"),
        ((F.col("keys") == BATCH_KEYS) & (F.col("rows") == BATCH_KEYS)).alias("equal"),
    )


def dedup_vintage(passengers: DataFrame) -> DataFrame:
    """One value per key and fetch time; ``conflicting`` marks disagreeing copies."""
    return passengers.groupBy(*KEY, "fetched_at").agg(
        F.min("expected_passengers").alias("expected_passengers"),
        (F.min("expected_passengers") != F.max("expected_passengers")).alias("conflicting"),
    )


def vintage_conflicts(passengers: DataFrame) -> DataFrame:
    """Violation row when one fetch time holds different values for a key."""
    shown = F.concat_ws("|", *[F.col(k).cast("string") for k in [*KEY, "fetched_at"]])
    return (
        dedup_vintage(passengers).where("conflicting")
        .agg(F.count("*").alias("n"), F.min(shown).alias("key")).where("n > 0")
        .select(F.lit("conflicting forecasts at one fetch time").alias("rule"), "n", "key")
    )


def batch_dates(passengers: DataFrame) -> DataFrame:
    """Target days each batch counts for: its header's, else the days of its rows."""
    derived = F.coalesce(F.col("target_date"), kst_date(F.col("target_hour")))
    return (
        passengers.groupBy("batch_id", derived.alias("for_date"))
        .agg(F.min("fetched_at").alias("fetched_at"), F.min("phase").alias("phase"))
    )


def changed_count(passengers: DataFrame) -> DataFrame:
    """Keys of each batch whose value differs from the previous batch of its day.

    The previous batch is found among batch headers; values are then compared by
    an equi-join on (previous batch, key), so no sequential state is needed.
    """
    order = Window.partitionBy("for_date").orderBy("fetched_at", "batch_id")
    headers = batch_dates(passengers).withColumn("previous_batch_id", F.lag("batch_id").over(order))
    current = passengers.withColumn(
        "for_date", F.coalesce(F.col("target_date"), kst_date(F.col("target_hour")))
    ).select("for_date", "batch_id", *KEY, "expected_passengers")
    earlier = passengers.select(
        F.col("batch_id").alias("previous_batch_id"), *KEY, F.col("expected_passengers").alias("_before")
    )
    compared = current.join(headers, ["for_date", "batch_id"]).join(earlier, ["previous_batch_id", *KEY], "left")
    return compared.groupBy("for_date", "batch_id", "previous_batch_id", "fetched_at", "phase").agg(
        F.count_if(~F.col("expected_passengers").eqNullSafe(F.col("_before"))).cast("int").alias("changed_count")
    )


def revision_filter(passengers: DataFrame) -> DataFrame:
    """Batches worth storing: first of their day, changed, or a baseline."""
    return changed_count(passengers).where(
        F.col("previous_batch_id").isNull() | (F.col("phase") == "baseline") | (F.col("changed_count") > 0)
    )


# What a request for forecasts may be for.
PHASES = ["manual", "baseline", "recheck"]


def batch_shape_violations(passengers: DataFrame, request: str | None = None) -> DataFrame:
    """Batches that are not one local day of 24 hours with unique keys, or of an unknown phase.

    Batches with the same ``request`` were asked for together and must be of different days.
    """
    shape = passengers.groupBy("batch_id").agg(
        F.count("*").alias("rows"),
        F.count_distinct(*KEY).alias("keys"),
        F.count_distinct(kst_date(F.col("target_hour"))).alias("days"),
        F.count_if(~F.coalesce(F.col("phase").isin(PHASES), F.lit(False))).alias("unknown"),
        *([] if request is None else [
            F.min(request).alias("_request"), F.min(F.coalesce("target_date", kst_date(F.col("target_hour")))).alias("_day"),
        ]),
    )
    rules = {
        "batch is not 24 hours of four totals": F.col("rows") != BATCH_KEYS,
        "batch repeats a key": F.col("rows") != F.col("keys"),
        "batch spans several days": F.col("days") != 1,
        "batch of an unknown phase": F.col("unknown") > 0,
    }
    hits = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    found = shape.select(F.explode(hits).alias("rule"), F.col("batch_id").cast("string").alias("key"))
    if request is not None:
        twice = shape.groupBy("_request", "_day").agg(F.count("*").alias("n"), F.min("batch_id").alias("batch_id"))
        found = found.unionByName(twice.where("n > 1").select(
            F.lit("request asks twice for a day").alias("rule"), F.col("batch_id").cast("string").alias("key")))
    return found.groupBy("rule").agg(F.count("*").alias("n"), F.min("key").alias("key"))


def pivot_direction(passengers: DataFrame, keys: list[str]) -> DataFrame:
    """Arrival and departure values side by side for each ``keys`` row."""
    return passengers.groupBy(*keys).agg(
        *[F.max(F.when(F.col("direction") == d, F.col("expected_passengers"))).alias(d) for d in DIRECTIONS]
    )


def day_windows(hours: DataFrame, day: str, arrival: str, departure: str, prefix: str = "") -> DataFrame:
    """Neighbouring-hour, cumulative and daily sums inside one local day.

    ``hours`` holds the full 24-hour grid per (day, terminal), so each window
    group has 24 rows.
    """
    whole = Window.partitionBy(day, "terminal")
    ordered = whole.orderBy("target_hour")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hours.select(
        "*",
        F.sum(arrival).over(ordered.rowsBetween(-2, -1)).alias(f"{prefix}arrival_previous_2h"),
        F.sum(departure).over(ordered.rowsBetween(1, 2)).alias(f"{prefix}departure_next_2h"),
        F.sum(arrival).over(upto).alias(f"{prefix}arrival_cumulative"),
        F.sum(departure).over(upto).alias(f"{prefix}departure_cumulative"),
        F.sum(arrival).over(whole).alias(f"{prefix}arrival_daily"),
        F.sum(departure).over(whole).alias(f"{prefix}departure_daily"),
    )


def passenger_day_features(
    passengers: DataFrame, cutoff_time: str, window_minutes: int | None = WINDOW_MINUTES
) -> DataFrame:
    """Hourly passenger features of each target day from its chosen batch."""
    chosen = forecast_batches(passengers, cutoff_time, window_minutes)
    rows = batch_window_filter(passengers, cutoff_time, window_minutes).drop("target_date").withColumn(
        "target_date", kst_date(F.col("target_hour"))
    )
    of_batch = rows.join(
        chosen,
        (rows.batch_id == chosen.forecast_batch_id) & (rows.target_date == chosen.target_date),
        "inner",
    ).drop(chosen.target_date)
    hours = pivot_direction(
        of_batch, ["target_date", "forecast_batch_id", "forecast_fetched_at", "terminal", "target_hour"]
    )
    features = day_windows(hours, "target_date", "arrival", "departure")
    return features.fillna(0, ["arrival_previous_2h", "departure_next_2h"])
