"""Readings summed up by lot, hour and the issue day that sees them first, kept up to date as readings land.

A reading is seen by every issue from its first one on, the first whose cutoff is not before the reading was observed and
collected. A summary row holds what adds up: counts, sums, extremes and slots of operating readings, and the latest
reading of any kind. Truth, the history of an issue and the anchors of an issue follow from these rows alone, so neither
scans readings again. When readings land, only the lot-hours they touch are summed up again, from the stored
readings of these hours; that also settles copies that were collected earlier than what is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.functions.lots import occupancy_ratio
from tidelot.functions.time import DEFAULT_CUTOFF, cutoff_at, first_issue, kst_date, span, with_floor
from tidelot.operators.quality import clean_parking
from tidelot.operators.truth import MINIMUM_SLOTS, RATIOS, shift_history, slot_bit

HOUR = ["lot_name", "target_hour"]
READING = ("collected_at", "observed_at", "occupied_spaces", "total_spaces")


def reading_summary(clean: DataFrame, cutoff_time: str = DEFAULT_CUTOFF) -> DataFrame:
    """One row per lot, UTC hour and ``known_from``, the first issue day that sees the readings; ``clean`` is deduplicated."""
    rows = with_floor(clean, "observed_at", "target_hour", "1 hour")
    operating = F.col("total_spaces") > 0
    ratio = F.when(operating, occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces")))
    return rows.groupBy(*HOUR, first_issue(F.greatest("collected_at", "observed_at"), cutoff_time).alias("known_from")).agg(
        F.count(ratio).alias("readings"), F.sum(ratio).alias("ratio_sum"), F.max(ratio).alias("ratio_max"),
        F.min(ratio).alias("ratio_min"), F.bit_or(F.when(operating, slot_bit("observed_at"))).alias("slots"),
        F.max(F.when(operating, F.col("collected_at"))).alias("available_at"), F.max(F.struct(*READING)).alias("latest"))


def touched_hours(delta: DataFrame) -> DataFrame:
    """The lot-hours of landed readings."""
    return with_floor(delta, "observed_at", "target_hour", "1 hour").select(*HOUR).distinct()


def summary_of_hours(stored: DataFrame, delta: DataFrame, hours: DataFrame, cutoff_time: str = DEFAULT_CUTOFF) -> DataFrame:
    """The new summary rows of ``hours``, from what is stored of them and what has landed."""
    both = with_floor(stored.unionByName(delta), "observed_at", "target_hour", "1 hour")
    return reading_summary(clean_parking(both.join(hours, HOUR, "left_semi").drop("target_hour")), cutoff_time)


def merge_summary(summary: DataFrame, stored: DataFrame, delta: DataFrame, cutoff_time: str = DEFAULT_CUTOFF) -> DataFrame:
    """``summary`` of ``stored`` readings brought up to date with ``delta``; other hours keep their rows."""
    hours = touched_hours(delta)
    return summary.join(hours, HOUR, "left_anti").unionByName(summary_of_hours(stored, delta, hours, cutoff_time))


def _statistics(seen: Column | None = None) -> dict[str, Column]:
    """Mean, largest and least ratio and the number of slots over summary rows for which ``seen`` holds."""
    of = lambda name: F.col(name) if seen is None else F.when(seen, F.col(name))
    return {
        "mean": F.sum(of("ratio_sum")) / F.sum(of("readings")), "max": F.max(of("ratio_max")), "min": F.min(of("ratio_min")),
        "slots": F.coalesce(F.bit_count(F.bit_or(of("slots"))), F.lit(0)).cast("int"),
    }


def summary_truth(summary: DataFrame, issue: Column | None = None, cutoff_time: str = DEFAULT_CUTOFF,
                  minimum_slots: int = MINIMUM_SLOTS) -> DataFrame:
    """:func:`tidelot.operators.truth.hourly_truth` of all readings, or as seen at the cutoff of ``issue``."""
    known = summary.where("readings > 0")
    if issue is not None:
        known = known.where(F.col("known_from") <= issue)
    stats = _statistics()
    grouped = known.groupBy(*HOUR).agg(*[c.alias(f"_{n}") for n, c in stats.items()], F.max("available_at").alias("label_available_at"))
    complete = F.col("_slots") >= minimum_slots
    if issue is not None:
        complete = complete & (F.col("target_hour") + span(hours=1) <= cutoff_at(issue, cutoff_time))
    return grouped.select(
        *HOUR, *[F.when(complete, F.col(f"_{s}")).alias(r) for r, s in zip(RATIOS, ("mean", "max", "min"), strict=True)],
        F.col("_slots").alias("observation_slots"), "label_available_at")


def summary_history(summary: DataFrame, cutoff_time: str = DEFAULT_CUTOFF) -> DataFrame:
    """:func:`tidelot.operators.truth.same_hour_history` from a summary."""
    day = kst_date(F.col("target_hour"))
    known = summary.where("readings > 0").withColumn("_day", day)
    views = {"day": 0, "week": 6}
    aggregates = [c.alias(f"_{v}_{n}") for v, days in views.items()
                  for n, c in _statistics(F.col("known_from") <= F.date_add("_day", days)).items()]
    grouped = known.groupBy(*HOUR, "_day").agg(*aggregates)
    columns = []
    for view, days in views.items():
        ended = F.col("target_hour") + span(hours=1) <= cutoff_at(F.date_add("_day", days), cutoff_time)
        complete = (F.col(f"_{view}_slots") >= MINIMUM_SLOTS) & ended
        columns += [F.when(complete, F.col(f"_{view}_{s}")).alias(f"{view}_{s}") for s in ("mean", "max", "min")]
    return shift_history(grouped.select(*HOUR, *columns))


def summary_anchors(summary: DataFrame) -> DataFrame:
    """``(lot_name, known_from, latest)``: the latest reading that each issue day is the first to see."""
    return summary.groupBy("lot_name", "known_from").agg(F.max("latest").alias("latest"))


def anchor_state(anchors: DataFrame, issue: Column) -> DataFrame:
    """What :func:`summary_anchors` comes to at ``issue``: one row a lot, in the same shape.

    The state and the rows of later days give the anchors of later issues, with no look further back.
    """
    known = anchors.where(F.col("known_from") <= issue)
    return known.groupBy("lot_name").agg(F.max("latest").alias("latest")).select("lot_name", issue.alias("known_from"), "latest")
