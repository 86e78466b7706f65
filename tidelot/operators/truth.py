"""Hourly truth: mean, max and min occupancy with a slot-coverage rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.functions.lots import occupancy_ratio
from tidelot.functions.time import cutoff_at, kst_date, span, with_floor
from tidelot.operators.quality import dedup_first, filter_operating, visible_as_of

# Least ten-minute slots of an hour, label and history columns.
MINIMUM_SLOTS = 4
RATIOS = ("actual_ratio", "actual_max_ratio", "actual_min_ratio")
HISTORY_COLUMNS = [
    "previous_day_same_hour", "previous_day_max", "previous_day_min",
    "previous_week_same_hour", "previous_week_max", "previous_week_min",
]


def slot_bit(observed_at: str) -> Column:
    return F.expr(f"shiftleft(1, cast(minute({observed_at}) div 10 as int))")


def _slots(condition: Column) -> Column:
    return F.coalesce(F.bit_count(F.bit_or(F.when(condition, F.col("_slot")))), F.lit(0)).cast("int")


def operating_readings(parking: DataFrame) -> DataFrame:
    """Operating readings with their UTC hour, slot and ratio."""
    hours = with_floor(filter_operating(parking), "observed_at", "target_hour", "1 hour")
    return hours.select(
        "lot_name", "target_hour", "observed_at", "collected_at",
        slot_bit("observed_at").alias("_slot"),
        occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces")).alias("_ratio"),
    )


def hourly_truth(
    parking: DataFrame,
    as_of: Column | None = None,
    minimum_slots: int = MINIMUM_SLOTS,
    *,
    deduplicate: bool = True,
) -> DataFrame:
    """Truth per lot and UTC hour, from what was visible at ``as_of``.

    Hours with too few ten-minute slots, or not ended at ``as_of``, keep their
    row and slot count but have null ratios.  ``deduplicate=False`` skips a
    shuffle for input that already went through ``dedup_first``.
    """
    known = filter_operating(parking)
    if as_of is not None:
        known = visible_as_of(known, as_of)
    if deduplicate:
        known = dedup_first(known)
    every = F.lit(True)
    grouped = operating_readings(known).groupBy("lot_name", "target_hour").agg(
        F.avg("_ratio").alias("actual_ratio"),
        F.max("_ratio").alias("actual_max_ratio"),
        F.min("_ratio").alias("actual_min_ratio"),
        _slots(every).alias("observation_slots"),
        F.max("collected_at").alias("label_available_at"),
    )
    complete = F.col("observation_slots") >= minimum_slots
    if as_of is not None:
        complete = complete & (F.col("target_hour") + span(hours=1) <= as_of)
    return grouped.select(
        "lot_name", "target_hour",
        *[F.when(complete, F.col(c)).alias(c) for c in RATIOS],
        "observation_slots", "label_available_at",
    )


def history_truth(parking: DataFrame, cutoff_time: str) -> DataFrame:
    """Truth of each lot-hour as seen from the two issues that use it.

    A reading of local day ``d`` serves issue ``d`` (as the previous day of the
    target) and issue ``d + 6`` (as the previous week).  Both views come from one
    aggregation of deduplicated readings with conditional aggregates, so nothing
    is recomputed per issue day.
    """
    readings = operating_readings(parking).select(
        "lot_name", "target_hour", "_slot", "_ratio",
        F.greatest("collected_at", "observed_at").alias("_visible"),
        cutoff_at(kst_date(F.col("target_hour")), cutoff_time).alias("_cutoff"),
    )
    views = {"day": 0, "week": 6}
    aggregates = []
    for name, days in views.items():
        seen = F.col("_visible") <= F.col("_cutoff") + span(days=days)
        ratio = F.when(seen, F.col("_ratio"))
        aggregates += [
            F.avg(ratio).alias(f"{name}_mean"), F.max(ratio).alias(f"{name}_max"),
            F.min(ratio).alias(f"{name}_min"), _slots(seen).alias(f"{name}_slots"),
        ]
    grouped = readings.groupBy("lot_name", "target_hour", "_cutoff").agg(*aggregates)
    columns = []
    for name, days in views.items():
        ended = F.col("target_hour") + span(hours=1) <= F.col("_cutoff") + span(days=days)
        complete = (F.col(f"{name}_slots") >= MINIMUM_SLOTS) & ended
        columns += [
            F.when(complete, F.col(f"{name}_{s}")).alias(f"{name}_{s}") for s in ("mean", "max", "min")
        ]
    return grouped.select("lot_name", "target_hour", *columns)


def same_hour_history(parking: DataFrame, cutoff_time: str) -> DataFrame:
    """Previous-day and previous-week truth keyed by the lot and hour they help predict.

    ``parking`` must be clean (deduplicated).  One row per lot and target hour.
    """
    return shift_history(history_truth(parking, cutoff_time))


def shift_history(seen: DataFrame) -> DataFrame:
    """The two views of each lot-hour, moved to the hours a day and a week later that they help predict."""
    fields = ("mean", "max", "min")
    names = {"day": dict(zip(fields, HISTORY_COLUMNS[:3])), "week": dict(zip(fields, HISTORY_COLUMNS[3:]))}
    shifted = F.array_compact(F.array(*[
        F.when(
            F.col(f"{view}_mean").isNotNull(),
            F.struct(
                (F.col("target_hour") + span(days=days)).alias("target_hour"),
                *[(F.col(f"{view}_{f}") if view == v else F.lit(None).cast("double")).alias(names[v][f])
                  for v in names for f in fields],
            ),
        )
        for view, days in (("day", 1), ("week", 7))
    ]))
    return (
        seen.select("lot_name", F.explode(shifted).alias("_s")).select("lot_name", "_s.*")
        .groupBy("lot_name", "target_hour")
        .agg(*[F.max(c).alias(c) for c in HISTORY_COLUMNS])
    )
