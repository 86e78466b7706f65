"""One-hour-ahead feature frame and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelot.functions.lots import lot_terminal, lot_type, occupancy_ratio
from tidelot.functions.time import local_calendar, minutes_between, span, with_floor
from tidelot.operators.asof import Channel, answer_events, asof_events, asof_lookup
from tidelot.operators.quality import filter_operating
from tidelot.operators.select import latest_by, operating_lots

LAGS = (10, 30, 60)
LAG_MAX_AGE_MINUTES = 20

# Feature lists, in model order.
CATEGORICAL = ["lot_name", "terminal", "lot_type"]
NUMERIC = [
    "current_ratio", "occupied_spaces", "total_spaces", "observation_age_minutes",
    "lag_10_ratio", "lag_30_ratio", "lag_60_ratio", "change_30", "change_60",
    "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "is_weekend",
    "passengers_now_arrival", "passengers_now_departure",
    "passengers_target_arrival", "passengers_target_departure",
]
LABEL_COLUMNS = ["actual_observed_at", "label_available_at", "actual_ratio", "actual_capacity"]


def origins(parking: DataFrame, horizon_minutes: int = 60) -> DataFrame:
    """One row per operating reading; it becomes known, and predicts, at collection time."""
    operating = filter_operating(parking).withColumn("origin_at", F.col("collected_at"))
    base = operating.withColumns({
        "requested_target_at": F.col("origin_at") + span(minutes=horizon_minutes),
        "current_ratio": occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces")),
        "terminal": lot_terminal(F.col("lot_name")),
        "lot_type": lot_type(F.col("lot_name")),
        "observation_age_minutes": minutes_between(F.col("observed_at"), F.col("origin_at")),
    })
    return base.withColumns(local_calendar(F.col("requested_target_at"), whole_hour=False))


def asof_lags(parking: DataFrame) -> DataFrame:
    """Ratios known 10, 30 and 60 minutes before each (lot, origin).

    The last reading by collection time wins, open or closed; a closed or stale
    winner gives null and no second choice is tried.  All lags share one lookup.
    """
    ratio = occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces"))
    operating = F.col("total_spaces") > 0
    shape = "struct<at:timestamp_ntz,tag:int,observed_at:timestamp_ntz,ratio:double>"
    reading = F.struct("collected_at", F.lit(0), "observed_at", ratio).cast(shape)
    queries = [
        F.when(operating, F.struct(F.col("collected_at") - span(minutes=m), F.lit(1 << i), F.lit(None), F.lit(None)).cast(shape))
        for i, m in enumerate(LAGS)
    ]
    events = parking.select("lot_name", F.explode(F.array_compact(F.array(reading, *queries))).alias("e")).select(
        "lot_name", "e.*"
    )
    channels = [Channel("past", "observed_at", ("observed_at", "ratio"))]
    answers = answer_events(
        asof_events(events, channels, ["lot_name"], F.col("at"), F.col("observed_at"), F.col("tag")),
        keys=["lot_name"], channels=channels,
    )
    fresh = minutes_between(F.col("past.observed_at"), F.col("at")) <= LAG_MAX_AGE_MINUTES
    usable = answers.select("lot_name", "at", "tag", F.when(fresh, F.col("past.ratio")).alias("ratio"))
    back = F.array_compact(F.array(*[
        F.when(
            F.col("tag").bitwiseAND(1 << i) != 0,
            F.struct((F.col("at") + span(minutes=m)).alias("origin_at"), F.lit(m).alias("lag")),
        )
        for i, m in enumerate(LAGS)
    ]))
    return (
        usable.where("ratio is not null")
        .select("lot_name", "ratio", F.explode(back).alias("b"))
        .groupBy("lot_name", F.col("b.origin_at").alias("origin_at"))
        .agg(*[F.max(F.when(F.col("b.lag") == m, F.col("ratio"))).alias(f"lag_{m}_ratio") for m in LAGS])
    )


DIRECTIONS = ("arrival", "departure")


def forecast_intervals(passengers: DataFrame) -> DataFrame:
    """What is known of each (terminal, target hour) from one fetch to the next.

    One row per fetch time with the newest value of each direction and when it was fetched, valid from ``valid_from``
    until before ``valid_until`` (null for the newest).
    """
    fetched = passengers.groupBy("terminal", "target_hour", F.col("fetched_at").alias("valid_from")).agg(
        *[F.max(F.when(F.col("direction") == d, F.col("expected_passengers"))).alias(d) for d in DIRECTIONS])
    order = Window.partitionBy("terminal", "target_hour").orderBy("valid_from")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return fetched.select(
        "terminal", "target_hour", "valid_from", F.lead("valid_from").over(order).alias("valid_until"),
        *[F.last(d, ignorenulls=True).over(upto).alias(d) for d in DIRECTIONS],
        *[F.last(F.when(F.col(d).isNotNull(), F.col("valid_from")), ignorenulls=True).over(upto).alias(f"{d}_at") for d in DIRECTIONS],
    )


def with_forecasts(records: DataFrame, passengers: DataFrame) -> DataFrame:
    """``records`` with the forecasts known at their origin for the current and the target hour.

    Availability is bounded by the origin for both hours. An origin meets the intervals of its terminal and hour and fits
    into one of them, so nothing passes through a window but the vintages. ``latest_forecast_used_at`` is the
    newest fetch time among the four values.
    """
    intervals = forecast_intervals(passengers)
    rows = with_floor(records, "origin_at", "_hour_now", "1 hour")
    rows = with_floor(rows, "requested_target_at", "_hour_target", "1 hour")
    for period in ("now", "target"):
        known = intervals.select(*[F.col(c).alias(f"_{period}_{c}") for c in intervals.columns])
        col = lambda name, period=period: F.col(f"_{period}_{name}")
        valid = (col("valid_from") <= F.col("origin_at")) & (col("valid_until").isNull() | (F.col("origin_at") < col("valid_until")))
        rows = rows.join(
            known, (F.col("terminal") == col("terminal")) & (F.col(f"_hour_{period}") == col("target_hour")) & valid, "left")
    return rows.select(
        *records.columns,
        *[F.col(f"_{period}_{d}").alias(f"passengers_{period}_{d}") for period in ("now", "target") for d in DIRECTIONS],
        F.greatest(*[F.col(f"_{period}_{d}_at") for period in ("now", "target") for d in DIRECTIONS]).alias("latest_forecast_used_at"),
    )


def asof_forecasts(records: DataFrame, passengers: DataFrame) -> DataFrame:
    """The forecasts of each (terminal, origin); all lots of a terminal share them."""
    asked = records.select("terminal", "origin_at", "requested_target_at").distinct()
    return with_forecasts(asked, passengers).drop("requested_target_at")


def build_features(parking: DataFrame, passengers: DataFrame, horizon_minutes: int = 60) -> DataFrame:
    """The hourly feature frame: one row per operating reading of clean ``parking``."""
    records = origins(parking, horizon_minutes)
    joined = with_forecasts(records.join(asof_lags(parking), ["lot_name", "origin_at"], "left"), passengers)
    return joined.withColumns({
        f"change_{m}": F.col("current_ratio") - F.col(f"lag_{m}_ratio") for m in (30, 60)
    })


def nearest_labels(records: DataFrame, parking: DataFrame, tolerance_minutes: int = 10) -> DataFrame:
    """The operating reading nearest to each (lot, requested target), inside the tolerance.

    Equal distances go to the earlier reading.
    """
    truth = filter_operating(parking).select(
        "lot_name", "observed_at", "collected_at", "total_spaces",
        occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces")).alias("ratio"),
    )
    columns = ("observed_at", "collected_at", "ratio", "total_spaces")
    answers = asof_lookup(
        records.select("lot_name", "requested_target_at"), truth, keys=["lot_name"],
        query_time="requested_target_at", history_time="observed_at", tie="collected_at",
        channels=[Channel("truth", "observed_at", columns)], following=True,
    )
    before = F.timestamp_diff("MICROSECOND", F.col("truth.observed_at"), F.col("at"))
    after = F.timestamp_diff("MICROSECOND", F.col("at"), F.col("next_truth.observed_at"))
    limit = tolerance_minutes * 60_000_000
    nearest = (
        F.when((before <= limit) & (after.isNull() | (before <= after)), F.col("truth"))
        .when(after <= limit, F.col("next_truth"))
    )
    return answers.select("lot_name", F.col("at").alias("requested_target_at"), nearest.alias("_n")).select(
        "lot_name", "requested_target_at",
        F.col("_n.observed_at").alias("actual_observed_at"),
        F.col("_n.collected_at").alias("label_available_at"),
        F.col("_n.ratio").alias("actual_ratio"),
        F.col("_n.total_spaces").alias("actual_capacity"),
    )


def attach_targets(records: DataFrame, parking: DataFrame, tolerance_minutes: int = 10) -> DataFrame:
    """Label records; a winner already known at the origin is blanked, not replaced."""
    labels = nearest_labels(records, parking, tolerance_minutes)
    joined = records.join(labels, ["lot_name", "requested_target_at"], "left")
    later = (F.col("actual_observed_at") > F.col("origin_at")) & (F.col("label_available_at") > F.col("origin_at"))
    keep: dict[str, Column] = {c: F.when(later, F.col(c)) for c in LABEL_COLUMNS}
    return joined.select(*[c for c in joined.columns if c not in keep], *[v.alias(k) for k, v in keep.items()])


def latest_records(records: DataFrame, parking: DataFrame) -> DataFrame:
    """The newest record of every lot whose latest reading shows it open."""
    open_now = records.join(operating_lots(parking), "lot_name", "left_semi")
    return latest_by(open_now, ["lot_name"], ["origin_at", "observed_at"])
