"""Registered queries: each runs an operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.views import spark_text, table, view
from tidelot.functions.lots import lot_terminal, lot_type, occupancy_ratio
from tidelot.functions.time import (
    DEFAULT_CUTOFF, from_instant, instant, local_calendar, parse_offset_timestamp, span, to_instant, to_kst,
)
from tidelot.operators import context, quality, scoring, select, splits, summaries, truth, vintages
from tidelot.plans import baselines, hourly, models, nextday, readiness
from tidelot.session import collect_garbage, materialize, scratch, scratch_path
from tidelot.sources import payloads, scan, store
from tidelot.streaming import flows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = datetime(2024, 1, 31)
ONE_ISSUE = date(2024, 1, 15)


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# Exact ratios of microseconds; both engines give the same double.
UNROUNDED = {"gap_minutes", "max_gap_minutes", "anchor_age_minutes", "observation_age_minutes"}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so summation order does not matter."""
    return df.select(*[
        F.round(c, 6).alias(c) if kind == "double" and c not in UNROUNDED else F.col(c) for c, kind in df.dtypes
    ])


# --- Landed payloads -------------------------------------------------------


def parking_items(spark: SparkSession, sf: str) -> DataFrame:
    """Raw items as the provider writes them; some carry an unusable count."""
    raw = view(spark, sf, "park_raw")
    stamp = F.date_format(to_kst(F.col("observed_at")), "yyyyMMddHHmmss.SSS")
    return raw.select(
        F.col("id").alias("request_id"), F.concat(F.lit(" "), "lot_name", F.lit("  ")).alias("floor"),
        F.when(F.col("id") % 53 == 0, F.lit("x")).otherwise(F.col("occupied_spaces").cast("string")).alias("parking"),
        F.col("total_spaces").cast("string").alias("parkingarea"), stamp.alias("datetm"),
    )


def parking_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Responses of 250 readings on three pages, in the provider's three shapes.

    Some requests failed, some report a total that does not match.
    """
    items = parking_items(spark, sf).withColumn("item", F.to_json(F.struct("floor", "parking", "parkingarea", "datetm")))
    request = F.floor(F.col("request_id") / 250)
    total = items.groupBy(request.alias("request_id")).agg(F.count("*").alias("total"))
    pages = items.groupBy(
        request.alias("request_id"), (F.floor(F.col("request_id") % 250 / 100) + 1).alias("page")
    ).agg(F.array_join(F.sort_array(F.collect_list("item")), ",").alias("list"))
    listed = F.concat(F.lit("["), "list", F.lit("]"))
    body = F.when(F.col("page") == 1, listed).otherwise(F.concat(F.lit('{"item":'), listed, F.lit("}")))
    code = F.when(F.col("request_id") % 11 == 5, "99").otherwise("00")
    count = F.col("total") + F.when(F.col("request_id") % 7 == 3, 1).otherwise(0)
    return pages.join(total, "request_id").select(
        "request_id", "page",
        F.format_string(
            '{"response":{"header":{"resultCode":"%s"},"body":{"totalCount":%s,"items":%s}}}', code, count, body
        ).alias("payload"),
    )


@register
def parse_parking_payload(spark, sf):
    items = payloads.parse_parking_payload(parking_pages(spark, sf))
    return items.select("request_id", "page", "floor", "parking", "parkingarea", "datetm")


@register
def page_violations(spark, sf):
    pages = payloads.envelope(parking_pages(spark, sf))
    return payloads.page_violations(pages, allow_empty=False).select("rule", "n")


@register
def normalize_parking(spark, sf):
    return payloads.normalize_parking(parking_items(spark, sf))


def passenger_items(spark: SparkSession, sf: str) -> DataFrame:
    """One raw hourly item per order, with daily totals and malformed items."""
    key = F.col("o_orderkey")
    hour = key % 24
    two = "%02d_%02d"
    atime = (
        F.when(key % 25 == 24, "합계").when(key % 41 == 0, "03_07")
        .otherwise(F.format_string(two, hour, F.when(key % 2 == 0, hour + 1).otherwise((hour + 1) % 24)))
    )
    return table(spark, sf, "orders").select(
        key.alias("request_id"),
        F.when(key % 25 == 24, "합계").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("adate"),
        atime.alias("atime"),
        (key % 977).cast("string").alias("t1egsum1"),
        F.concat((key % 613).cast("string"), F.lit(".0")).alias("t1dgsum1"),
        F.when(key % 37 == 0, "-4").otherwise((F.col("o_custkey") % 500).cast("string")).alias("t2egsum1"),
        F.when(key % 43 == 0, "12.5").otherwise((F.col("o_custkey") % 300).cast("string")).alias("t2dgsum2"),
    )


@register
def normalize_passenger(spark, sf):
    return payloads.normalize_passenger(passenger_items(spark, sf))


@register
def is_summary_row(spark, sf):
    from tidelot.functions.passengers import is_summary_row as expression

    flagged = passenger_items(spark, sf).withColumn("is_summary", expression(F.col("adate"), F.col("atime")))
    return flagged.groupBy("is_summary").agg(F.count("*").alias("n"))


# --- Readings: filters, projections, quality -------------------------------


def parking(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean_parking(view(spark, sf, "park_raw"))


@register
def dedup_first(spark, sf):
    return quality.dedup_first(view(spark, sf, "park_raw"))


@register
def filter_clock_order(spark, sf):
    return quality.filter_clock_order(view(spark, sf, "park_raw"))


@register
def filter_operating(spark, sf):
    return quality.filter_operating(parking(spark, sf))


@register
def visible_as_of(spark, sf):
    return quality.visible_as_of(parking(spark, sf), instant(datetime(2024, 1, 20, 8, 15)))


@register
def duplicate_and_clock_counts(spark, sf):
    return quality.duplicate_and_clock_counts(view(spark, sf, "park_raw"))


@register
def gap_minutes(spark, sf):
    return rounded(quality.gap_minutes(parking(spark, sf)).select("id", "lot_name", "observed_at", "gap_minutes"))


@register
def quality_per_lot(spark, sf):
    return rounded(quality.quality_per_lot(parking(spark, sf)))


@register
def quality_global(spark, sf):
    return rounded(quality.quality_global(parking(spark, sf)))


@register
def violations(spark, sf):
    """The rule checks on readings that break some of them."""
    raw = view(spark, sf, "park_raw")
    broken = raw.withColumns({
        "lot_name": F.when(F.col("id") % 61 == 0, F.lit(" ")).otherwise(F.col("lot_name")),
        "occupied_spaces": F.when(F.col("id") % 67 == 0, -F.col("occupied_spaces") - 1).otherwise(F.col("occupied_spaces")),
    })
    return quality.violations(broken, quality.parking_rules(), F.lpad(F.col("id").cast("string"), 12, "0"))


@register
def lot_columns(spark, sf):
    """occupancy_ratio, lot_terminal, lot_type and ages of each operating reading."""
    rows = hourly.origins(parking(spark, sf))
    return rounded(rows.select(
        "id", "current_ratio", "terminal", "lot_type", "observation_age_minutes", "origin_at", "requested_target_at"
    ))


@register
def occupancy_ratio_by_lot(spark, sf):
    rows = quality.filter_operating(parking(spark, sf))
    ratio = occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces"))
    return rounded(
        rows.groupBy(lot_terminal(F.col("lot_name")).alias("terminal"), lot_type(F.col("lot_name")).alias("lot_type"))
        .agg(F.count("*").alias("rows"), F.avg(ratio).alias("mean_ratio"), F.max(ratio).alias("max_ratio"),
             F.count_if(ratio > 1).alias("over_capacity"))
    )


@register
def cyclic_time_hourly(spark, sf):
    cycle = local_calendar(F.col("collected_at") + span(minutes=60), whole_hour=False)
    return rounded(quality.filter_operating(parking(spark, sf)).select("id", *[v.alias(k) for k, v in cycle.items()]))


@register
def cyclic_time_nextday(spark, sf):
    hours = truth.hourly_truth(parking(spark, sf), deduplicate=False)
    cycle = local_calendar(F.col("target_hour"), whole_hour=True)
    return rounded(hours.select("lot_name", "target_hour", *[v.alias(k) for k, v in cycle.items()]))


@register
def latest_per_lot(spark, sf):
    return select.latest_per_lot(parking(spark, sf))


@register
def semi_operating_lots(spark, sf):
    rows = parking(spark, sf)
    return rows.join(select.operating_lots(rows), "lot_name", "left_semi").groupBy("lot_name").agg(
        F.count("*").alias("rows")
    )


@register
def latest_n_observations(spark, sf):
    columns = ["lot_name", "observed_at", "occupied_spaces", "total_spaces"]
    return select.latest_n(parking(spark, sf).select(*columns), [F.desc("observed_at"), F.col("lot_name")], 10)


@register
def latest_n_forecasts(spark, sf):
    rows = join_batches(spark, sf)
    order = [F.desc("fetched_at"), F.col("target_hour"), F.col("terminal"), F.col("direction")]
    return select.latest_n(rows, order, 20)


@register
def plain_limit(spark, sf):
    columns = ["batch_id", "target_hour", "terminal", "direction", "expected_passengers"]
    return select.latest_n(view(spark, sf, "vintages").select(*columns), [F.col(c) for c in columns], 1000)


@register
def delta_range_scan(spark, sf):
    return select.delta_range_scan(view(spark, sf, "park_raw"), "id", 500, 1_000_000_400)


@register
def max_cursor(spark, sf):
    return select.max_cursor(view(spark, sf, "park_raw"), "id")


# --- Truth -----------------------------------------------------------------


@register
def hourly_truth(spark, sf):
    return rounded(truth.hourly_truth(view(spark, sf, "park_raw")))


@register
def hourly_truth_as_of(spark, sf):
    return rounded(truth.hourly_truth(view(spark, sf, "park_raw"), instant(datetime(2024, 1, 20, 8, 15))))


@register
def same_hour_history(spark, sf):
    return rounded(truth.same_hour_history(parking(spark, sf), DEFAULT_CUTOFF))


# --- As-of and nearest -----------------------------------------------------


@register
def asof_lag(spark, sf):
    rows = parking(spark, sf)
    base = hourly.origins(rows).select("id", "lot_name", "origin_at", "current_ratio")
    lagged = base.join(hourly.asof_lags(rows), ["lot_name", "origin_at"], "left")
    return rounded(lagged.withColumns({
        f"change_{m}": F.col("current_ratio") - F.col(f"lag_{m}_ratio") for m in (30, 60)
    }))


@register
def asof_forecast(spark, sf):
    base = hourly.origins(parking(spark, sf)).select("id", "terminal", "origin_at", "requested_target_at")
    found = hourly.asof_forecasts(base, view(spark, sf, "vintages"))
    return base.join(found, ["terminal", "origin_at"], "left").drop("requested_target_at")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    rows = parking(spark, sf)
    base = hourly.origins(rows).select("id", "lot_name", "origin_at", "requested_target_at", "current_ratio")
    return hourly.attach_targets(base, rows)


@register
def nearest_label(spark, sf):
    return rounded(labelled(spark, sf))


@register
def build_features(spark, sf):
    features = hourly.build_features(parking(spark, sf), view(spark, sf, "vintages"))
    keep = ["id", "origin_at", "latest_forecast_used_at", *hourly.CATEGORICAL, *hourly.NUMERIC]
    return rounded(features.select(*keep))


@register
def label_required(spark, sf):
    return rounded(labelled(spark, sf).where("actual_ratio is not null").groupBy("lot_name").agg(
        F.count("*").alias("labelled"), F.avg("actual_ratio").alias("mean_actual")
    ))


@register
def forecast_feature_coverage(spark, sf):
    base = hourly.origins(parking(spark, sf)).select("terminal", "origin_at", "requested_target_at")
    found = hourly.asof_forecasts(base, view(spark, sf, "vintages"))
    return rounded(scoring.forecast_feature_coverage(base.join(found, ["terminal", "origin_at"], "left")))


@register
def latest_anchor(spark, sf):
    issues = nextday.issue_days(view(spark, sf, "vintages"))
    return nextday.latest_anchors(parking(spark, sf), issues)


@register
def latest_anchor_state(spark, sf):
    """Anchors of all issues: to the 15th from all readings, later ones from the state of the 15th and later days alone."""
    issues = nextday.issue_days(view(spark, sf, "vintages"))
    anchors = summaries.summary_anchors(summaries.reading_summary(parking(spark, sf)))
    edge = F.lit(ONE_ISSUE)
    later = summaries.anchor_state(anchors, edge).unionByName(anchors.where(F.col("known_from") > edge))
    return nextday.carried_anchors(anchors, issues.where(F.col("issue_date") <= edge)).unionByName(
        nextday.carried_anchors(later, issues.where(F.col("issue_date") > edge)))


@register
def truth_incremental(spark, sf):
    """Hourly truth from a summary of the readings to the 12th and two merges of what was collected later."""
    raw = view(spark, sf, "park_raw")
    seen, edges = F.col("collected_at"), [instant(datetime(2024, 1, d)) for d in (12, 20)]
    first, second, third = raw.where(seen < edges[0]), raw.where((seen >= edges[0]) & (seen < edges[1])), raw.where(seen >= edges[1])
    summary = summaries.reading_summary(quality.clean_parking(first))
    summary = summaries.merge_summary(summary, first, second)
    summary = summaries.merge_summary(summary, first.unionByName(second), third)
    return rounded(summaries.summary_truth(summary))


@register
def history_from_summary(spark, sf):
    """The history of each lot-hour from the summary in place of the readings."""
    return rounded(summaries.summary_history(summaries.reading_summary(parking(spark, sf)), DEFAULT_CUTOFF))


# --- Vintages --------------------------------------------------------------


@register
def join_batches(spark, sf):
    rows = view(spark, sf, "vintages")
    batches = rows.groupBy("batch_id").agg(F.min("fetched_at").alias("fetched_at"), F.min("phase").alias("phase"))
    return select.join_batches(
        rows.select("batch_id", "target_hour", "terminal", "direction", "expected_passengers"), batches
    )


@register
def batch_complete(spark, sf):
    return vintages.forecast_batches(view(spark, sf, "vintages"), DEFAULT_CUTOFF)


@register
def batch_window_filter(spark, sf):
    rows = vintages.batch_window_filter(view(spark, sf, "vintages"), DEFAULT_CUTOFF)
    return rows.select("batch_id", "fetched_at", "target_hour", "terminal", "direction", "expected_passengers")


@register
def key_set_equal(spark, sf):
    return vintages.key_set_equal(view(spark, sf, "vintages").drop("target_date"))


@register
def batch_shape_valid(spark, sf):
    """Batches of the forecasts, some of an unknown phase; those of a month's third are one request."""
    rows = view(spark, sf, "vintages").withColumns({
        "phase": F.when(F.col("batch_id") % 17 == 0, "again").otherwise(F.col("phase")),
        "request": F.floor(F.col("batch_id") / 30),
    })
    return vintages.batch_shape_violations(rows, "request").select("rule", "n")


@register
def dedup_vintage(spark, sf):
    return vintages.dedup_vintage(view(spark, sf, "vintages"))


@register
def exists_fallback(spark, sf):
    return vintages.batch_dates(view(spark, sf, "vintages"))


@register
def changed_count(spark, sf):
    return vintages.changed_count(view(spark, sf, "vintages"))


@register
def revision_filter(spark, sf):
    return vintages.revision_filter(view(spark, sf, "vintages")).select("for_date", "batch_id", "changed_count")


@register
def pivot_direction(spark, sf):
    return vintages.pivot_direction(view(spark, sf, "vintages"), ["batch_id", "terminal", "target_hour"])


@register
def passenger_day_features(spark, sf):
    """prev_2h_arrivals, next_2h_departures, cumulative_day and passenger_daily_total."""
    return vintages.passenger_day_features(view(spark, sf, "vintages"), DEFAULT_CUTOFF)


@register
def calendar_grid(spark, sf):
    days = view(spark, sf, "flights").select("target_date").distinct()
    return vintages.calendar_grid(days, "target_date")


# --- Context ---------------------------------------------------------------


def context_tables(spark: SparkSession, sf: str) -> nextday.Context:
    return nextday.Context(*[view(spark, sf, n) for n in ("headers", "flights", "holidays")])


def target_days(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "flights").select("target_date").distinct()


@register
def snapshot_inventory(spark, sf):
    tables = context_tables(spark, sf)
    records = tables.flights.select("snapshot_id").unionByName(tables.holidays.select("snapshot_id"))
    return select.snapshot_inventory(tables.headers, records)


@register
def latest_snapshot(spark, sf):
    return context.latest_flight_snapshots(view(spark, sf, "headers"), DEFAULT_CUTOFF)


@register
def codeshare_collapse(spark, sf):
    return context.codeshare_collapse(view(spark, sf, "flights")).drop("problem")


@register
def flight_problems(spark, sf):
    """Reasons for unusable records per target day, after breaking some of them."""
    tables = context_tables(spark, sf)
    rows = tables.flights.withColumn("k", F.regexp_extract("flight_id", r"F(\d+)", 1).cast("bigint"))
    broken = rows.withColumns({
        "master_flight_id": F.when(F.col("k") % 1009 == 7, "").otherwise(F.col("master_flight_id")),
        "terminal_id": F.when(F.col("k") % 1013 == 8, "P09").otherwise(F.col("terminal_id")),
        "scheduled_text": F.when(F.col("k") % 1019 == 9, "20240230 900").otherwise(F.col("scheduled_text")),
    })
    return context.flight_problems(tables.headers, broken, DEFAULT_CUTOFF).select("target_date", "problem")


@register
def flight_hourly_counts(spark, sf):
    chosen = context.latest_flight_snapshots(view(spark, sf, "headers"), DEFAULT_CUTOFF)
    return context.flight_hourly_counts(view(spark, sf, "flights"), chosen).drop("problem")


@register
def flight_day_features(spark, sf):
    tables = context_tables(spark, sf)
    days = target_days(spark, sf)
    return context.flight_day_features(tables.headers, tables.flights, days, DEFAULT_CUTOFF).drop("flight_problem")


@register
def holiday_flags(spark, sf):
    tables = context_tables(spark, sf)
    return context.holiday_flags(tables.headers, tables.holidays, target_days(spark, sf), DEFAULT_CUTOFF)


# --- Next-day frames -------------------------------------------------------


def nextday_rows(spark: SparkSession, sf: str, window_minutes: int | None = vintages.WINDOW_MINUTES) -> DataFrame:
    forecasts = view(spark, sf, "vintages").drop("target_date")
    issues = nextday.issue_days(forecasts)
    return nextday.build_days(
        parking(spark, sf), forecasts, context_tables(spark, sf), issues, window_minutes=window_minutes
    )


BUILD_COLUMNS = [
    "issue_date", "target_date", "origin_at", "target_hour", "anchor_observed_at", "anchor_collected_at",
    "forecast_batch_id", "forecast_fetched_at",
    *nextday.CATEGORICAL, *nextday.BASE_NUMERIC, *nextday.CONTEXT_NUMERIC,
]


@register
def build_day(spark, sf):
    return rounded(nextday_rows(spark, sf, None).select(*BUILD_COLUMNS))


@register
def build_one_day(spark, sf):
    """The rows of a single issue day; scans are cut to its days."""
    forecasts = view(spark, sf, "vintages").drop("target_date")
    issues = spark.createDataFrame([(ONE_ISSUE,)], "issue_date date")
    rows = nextday.build_days(parking(spark, sf), forecasts, context_tables(spark, sf), issues, window_minutes=None)
    return rounded(rows.select(*BUILD_COLUMNS))


def training_rows(spark: SparkSession, sf: str, minimum_slots: int = truth.MINIMUM_SLOTS) -> DataFrame:
    rows, _ = nextday.build_training(
        parking(spark, sf), view(spark, sf, "vintages").drop("target_date"), context_tables(spark, sf),
        instant(AS_OF), minimum_slots=minimum_slots,
    )
    return rows


@register
def build_training(spark, sf):
    columns = [*BUILD_COLUMNS, *truth.RATIOS, "observation_slots", "label_available_at"]
    return rounded(training_rows(spark, sf).select(*columns))


@register
def skipped_days(spark, sf):
    forecasts = view(spark, sf, "vintages").drop("target_date")
    return nextday.skipped_days(
        parking(spark, sf), forecasts, context_tables(spark, sf), nextday.past_issues(forecasts, instant(AS_OF))
    )


@register
def context_coverage(spark, sf):
    return context.context_coverage(nextday_rows(spark, sf))


@register
def complete_target_days(spark, sf):
    return splits.complete_target_days(training_rows(spark, sf, 1)).select("target_date")


# --- Splits, baselines, scoring --------------------------------------------


def hourly_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).where("actual_ratio is not null")


@register
def temporal_split(spark, sf):
    rows = hourly_dataset(spark, sf)
    return splits.temporal_split(rows).select("id", "origin_at", "label_available_at", "split")


@register
def split_boundaries(spark, sf):
    return splits.split_boundaries(hourly_dataset(spark, sf))


@register
def split_sizes(spark, sf):
    return splits.split_sizes(splits.temporal_split(hourly_dataset(spark, sf)))


@register
def readiness_hourly(spark, sf):
    """Every rule of hourly training: what was found, what is wanted."""
    return rounded(readiness.hourly_rules(splits.temporal_split(hourly_dataset(spark, sf))))


@register
def readiness_nextday(spark, sf):
    return readiness.nextday_rules(training_rows(spark, sf, 1))


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows by day; they are built once, the split reads them for its days, its bounds and its rows."""
    return splits.day_split(materialize(training_rows(spark, sf, 1), "training"))


@register
def day_split(spark, sf):
    split = split_rows(spark, sf)
    return split.select("lot_name", "target_hour", "target_date", "label_available_at", "split")


@register
def context_complete_days(spark, sf):
    split = split_rows(spark, sf).where("split is not null")
    return scoring.context_complete_days(split, ["split"])


def with_baseline(rows: DataFrame, kind: str) -> DataFrame:
    values = baselines.persistence() if kind == "persistence" else baselines.seasonal()
    return baselines.with_forecast(rows, values)


@register
def persistence(spark, sf):
    rows = with_baseline(training_rows(spark, sf), "persistence")
    return rounded(rows.select("lot_name", "target_hour", *scoring.PREDICTED.values()))


@register
def seasonal(spark, sf):
    rows = with_baseline(training_rows(spark, sf), "seasonal")
    return rounded(rows.select("lot_name", "target_hour", *scoring.PREDICTED.values()))


@register
def nextday_outputs(spark, sf):
    rows = with_baseline(nextday_rows(spark, sf), "seasonal")
    # Half spaces must not hang on the summation order of a mean.
    rows = rows.withColumns({c: F.round(c, 8) for c in scoring.PREDICTED.values()})
    out = baselines.nextday_outputs(rows, "seasonal", is_learned=False, generated_at=instant(AS_OF))
    return rounded(out.select(
        "issue_date", "lot_name", "target_hour", "predicted_occupancy_pct", "predicted_max_occupancy_pct",
        "predicted_min_occupancy_pct", "estimated_occupied_spaces", "predicted_busy", "predicted_max_busy",
        "model", "prediction_kind", "context_used_by_model", "generated_at", "target_definition",
    ))


@register
def hourly_outputs(spark, sf):
    rows = parking(spark, sf)
    latest = hourly.latest_records(hourly.origins(rows), rows)
    predicted = latest.withColumn("predicted_ratio", F.greatest("current_ratio", F.lit(0.0)))
    return rounded(baselines.hourly_outputs(predicted, "persistence", instant(AS_OF)))


@register
def order_min_mean_max(spark, sf):
    """Learned-style values, some negative, clamped and ordered."""
    rows = training_rows(spark, sf)
    raw = rows.withColumns({
        "raw_mean": F.col("current_ratio") - 0.3, "raw_max": F.col("actual_max_ratio") - 0.4,
        "raw_min": F.col("actual_min_ratio") + 0.1,
    })
    values = baselines.learned({"mean": "raw_mean", "max": "raw_max", "min": "raw_min"})
    return rounded(baselines.with_forecast(raw, values).select("lot_name", "target_hour", *scoring.PREDICTED.values()))


@register
def forecast_metrics(spark, sf):
    rows = labelled(spark, sf).where("actual_ratio is not null")
    return rounded(scoring.forecast_metrics(rows, "actual_ratio", "current_ratio"))


@register
def per_lot_metrics(spark, sf):
    rows = labelled(spark, sf).where("actual_ratio is not null")
    named = rows.withColumns({"persistence": F.col("current_ratio"), "damped": F.col("current_ratio") * 0.9})
    return rounded(scoring.candidate_metrics(named, "actual_ratio", ["persistence", "damped"], ["lot_name"]))


@register
def statistic_metrics(spark, sf):
    return rounded(scoring.statistic_metrics(with_baseline(training_rows(spark, sf), "seasonal")))


@register
def metrics_by_group(spark, sf):
    rows = with_baseline(training_rows(spark, sf), "persistence").withColumn("context_used_by_model", F.lit(False))
    return rounded(scoring.metrics_by_group(rows))


def evaluated(spark: SparkSession, sf: str, as_of: datetime) -> DataFrame:
    issued = with_baseline(nextday_rows(spark, sf), "seasonal").select(
        "issue_date", "target_date", "lot_name", "target_hour", "current_ratio", *context.AVAILABILITY,
        *scoring.PREDICTED.values()
    )
    labels = truth.hourly_truth(parking(spark, sf), instant(as_of), deduplicate=False)
    return scoring.evaluate_nextday(issued, labels, instant(as_of))


@register
def evaluate_nextday(spark, sf):
    return rounded(evaluated(spark, sf, datetime(2024, 1, 20)).select(
        "issue_date", "lot_name", "target_hour", "evaluation_status",
        *[f"{s}_absolute_error_percentage_points" for s in scoring.STATISTICS],
    ))


@register
def eval_summary_nextday(spark, sf):
    as_of = datetime(2024, 1, 20)
    return rounded(scoring.eval_summary_nextday(evaluated(spark, sf, as_of), instant(as_of)))


@register
def eval_summary_hourly(spark, sf):
    rows = labelled(spark, sf).withColumn("predicted_ratio", F.col("current_ratio") * 0.9)
    return rounded(scoring.eval_summary_hourly(scoring.evaluate_hourly(rows)))


@register
def backtest_hourly_mean(spark, sf):
    rows = labelled(spark, sf).where("actual_ratio is not null").withColumn("persistence", F.col("current_ratio"))
    return rounded(scoring.backtest_hourly_mean(rows, ["actual_ratio", "persistence"]))


def baseline_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Mean absolute error of both baselines per statistic, in one pass over the training rows."""
    rows = training_rows(spark, sf)
    values = {k: {s: f"_{k}_{s}" for s in scoring.STATISTICS} for k in ("persistence", "seasonal")}
    for kind, names in values.items():
        given = baselines.persistence() if kind == "persistence" else baselines.seasonal()
        rows = baselines.with_forecast(rows, given, names)
    return rows.agg(*[
        (F.avg(F.abs(F.col(scoring.ACTUAL[s]) - F.col(name))) * 100).alias(f"{kind}_{s}")
        for kind, names in values.items() for s, name in names.items()
    ])


@register
def argmin_model(spark, sf):
    """Choice between the baselines by their mean error over three statistics."""
    kinds = ["persistence", "seasonal"]
    errors = baseline_errors(spark, sf).select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("model"), (sum(F.col(f"{k}_{s}") for s in scoring.STATISTICS) / 3).alias("error"))
        for k in kinds
    ])).alias("e")).select("e.*")
    return scoring.argmin_model(errors, kinds)


@register
def improvement_pct(spark, sf):
    """Gain of the seasonal baseline over persistence per statistic."""
    gains = F.array(*[
        F.struct(F.lit(s).alias("statistic"), scoring.improvement_pct(
            F.col(f"persistence_{s}"), F.col(f"seasonal_{s}")).alias("improvement_pct"))
        for s in scoring.STATISTICS
    ])
    return rounded(baseline_errors(spark, sf).select(F.explode(gains).alias("g")).select("g.*"))


# --- Store and streams -----------------------------------------------------


def stored_and_delta(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Readings collected before the 20th as the store, and those from the 18th on as the delta."""
    raw = view(spark, sf, "park_raw")
    edge = {d: instant(datetime(2024, 1, d)) for d in (18, 20)}
    return raw.where(F.col("collected_at") < edge[20]), raw.where(F.col("collected_at") >= edge[18])


@register
def merge_immutable(spark, sf):
    stored, delta = stored_and_delta(spark, sf)
    return store.new_rows(delta, stored, ["id"])


@register
def delta_violations(spark, sf):
    """A delta that replays stored rows, changes some and repeats others."""
    stored, delta = stored_and_delta(spark, sf)
    changed = F.when(F.col("id") % 71 == 0, F.col("occupied_spaces") + 5).otherwise(F.col("occupied_spaces"))
    broken = delta.withColumn("occupied_spaces", changed).unionByName(delta.where("id % 83 = 0"))
    found = store.delta_violations(broken, stored, ["id"], "id", 300, 1_000_000_900)
    return found.select("rule", "n")


@register
def sink_parking_insert_ignore(spark, sf):
    stored, delta = stored_and_delta(spark, sf)
    keys = ["source", "lot_name", "observed_at"]
    return store.insert_ignore(delta, stored, keys, ["collected_at", "id"], "observed_at")


@register
def sink_vintage_if_changed(spark, sf):
    rows = view(spark, sf, "vintages").withColumn("changed_count", F.lit(None).cast("int"))
    edge = instant(datetime(2024, 1, 10))
    return store.vintages_to_store(
        rows.where(F.col("fetched_at") >= edge), rows.where(F.col("fetched_at") < edge)
    ).select("batch_id", "target_hour", "terminal", "direction", "expected_passengers", "changed_count")


@register
def merge_checked(spark, sf):
    """What a merge finds in a delta that replays, changes and repeats rows, and what it finds without the faults."""
    stored, delta = stored_and_delta(spark, sf)
    changed = F.when(F.col("id") % 71 == 0, F.col("occupied_spaces") + 5).otherwise(F.col("occupied_spaces"))
    broken = delta.withColumn("occupied_spaces", changed).unionByName(delta.where("id % 83 = 0").withColumn("occupied_spaces", changed))
    report = lambda rows, name, low: store.merge_report(rows, stored, ["id"], "id", low, 1 << 40).withColumn("delta", F.lit(name))
    return report(broken, "broken", 9000).unionByName(report(delta, "clean", 0))


def reading_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The readings view over a file stream of the events table."""
    schema = table(spark, sf, "events").schema
    events = flows.read_files(spark, sf, schema, "events.parquet")
    return spark.sql(spark_text("park_raw"), events=events)


def drained(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    flows.drain_to_parquet(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def final_watermark(readings: DataFrame, lateness: str = flows.LATENESS) -> DataFrame:
    """Where the watermark stands when all readings have come: one row."""
    last = F.timestamp_millis(F.unix_millis(F.max(to_instant(F.col("observed_at")))))
    return readings.agg(from_instant(last - F.expr(f"INTERVAL {lateness}")).alias("watermark"))


@register
def stream_hourly_truth(spark, sf):
    """What the stream emits, and from the batch operator only the hours that the watermark has not passed at the end.

    An earlier hour that the stream loses is missing here; one that it emits too early is there twice.
    """
    raw = view(spark, sf, "park_raw")
    streamed = drained(spark, flows.stream_hourly_truth(reading_stream(spark, sf)), "stream-truth")
    watermark = final_watermark(raw.where("total_spaces > 0"))
    still_open = truth.hourly_truth(raw).join(watermark, F.col("target_hour") + span(hours=1) > F.col("watermark"))
    return rounded(streamed.union(still_open.select(*streamed.columns)))


@register
def stream_dedup(spark, sf):
    """The readings the stream keeps, and from the batch operator only those that the watermark has not passed at the end."""
    raw = view(spark, sf, "park_raw")
    streamed = drained(spark, flows.stream_dedup(reading_stream(spark, sf)), "stream-dedup")
    still_open = quality.dedup_first(raw).join(final_watermark(raw), F.col("observed_at") > F.col("watermark"))
    return streamed.union(still_open.select(*streamed.columns))


@register
def stream_ingest(spark, sf):
    """All readings through a stream into a store, and the first epoch once more; what the store holds then."""
    root, name = scratch_path(spark, "stream-store"), "readings"
    merge = flows.ingest_into(spark, root, "parking", name)
    flows.drain_batches(reading_stream(spark, sf), merge, scratch_path(spark, "ingest-checkpoint"))
    merge(view(spark, sf, "park_raw").where("id % 2 = 0").withColumn("id", F.col("id") + (1 << 50)), 0)
    return store.read_table(spark, root, "parking")


#: When the slices of readings end that land one after the other; the last slice is open.
LANDINGS = [datetime(2024, 1, d) for d in (5, 9, 13, 17, 21, 25)]
WATCHED_LATENESS = "1 hour"


@register
def stream_late_rows(spark, sf):
    """Readings that come behind the watermark of a stream, slice by slice, and the truth of their hours after the repair."""
    raw = view(spark, sf, "park_raw")
    landed, out, checkpoint = (scratch_path(spark, n) for n in ("late-landed", "late-rows", "late-checkpoint"))
    watch = flows.watch_late(spark, out, WATCHED_LATENESS)
    edges = [None, *LANDINGS, None]
    for low, high in zip(edges[:-1], edges[1:]):
        seen = F.col("collected_at")
        slice_ = raw if low is None else raw.where(seen >= instant(low))
        (slice_ if high is None else slice_.where(seen < instant(high))).write.mode("append").parquet(landed)
        flows.drain_batches(flows.read_files(spark, landed, raw.schema.simpleString()[7:-1].replace(":", " ")), watch, checkpoint)
    return rounded(flows.repaired_truth(flows.late_rows(spark, out, raw.schema), raw))


# --- Collection rules ------------------------------------------------------


def passenger_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed responses of forty items, some under an ``item`` object."""
    items = passenger_items(spark, sf)
    fields = [c for c in items.columns if c != "request_id"]
    request = F.floor(F.col("request_id") / 160)
    lists = items.groupBy(request.alias("request_id")).agg(
        F.count("*").alias("total"), F.array_join(F.sort_array(F.collect_list(F.to_json(F.struct(*fields)))), ",").alias("list"))
    listed = F.concat(F.lit("["), "list", F.lit("]"))
    body = F.when(F.col("request_id") % 2 == 0, listed).otherwise(F.concat(F.lit('{"item":'), listed, F.lit("}")))
    return lists.select("request_id", F.lit(1).alias("page"), F.format_string(
        '{"response":{"header":{"resultCode":"00"},"body":{"totalCount":%s,"items":%s}}}', F.col("total"), body).alias("payload"))


@register
def parse_passenger_payload(spark, sf):
    return payloads.parse_passenger_payload(passenger_pages(spark, sf)).drop("pos")


@register
def passenger_date_rule(spark, sf):
    """Responses for today, tomorrow or the day after, some dated one day late."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    rows = table(spark, sf, "orders").select(
        key.alias("request_id"), (day.cast("timestamp_ntz") + span(minutes=180)).alias("fetched_at"),
        (key % 3).cast("int").alias("day_offset"),
        F.date_format(F.date_add(day, (key % 3 + F.when(key % 29 == 0, 1).otherwise(0)).cast("int")), "yyyyMMdd").alias("adate"),
    )
    return payloads.passenger_date_violations(rows).select("rule", "n")


@register
def strict_timestamps(spark, sf):
    """Times written with two offsets, read back as UTC."""
    shifted = F.when(F.col("event_id") % 2 == 0, to_kst(F.col("ts").cast("timestamp_ntz"))).otherwise(F.col("ts").cast("timestamp_ntz"))
    text = F.concat(
        F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "+09:00").otherwise("Z"))
    return table(spark, sf, "events").select("event_id", parse_offset_timestamp(text).alias("utc"))


@register
def delta_text_rules(spark, sf):
    """The checks on a delta read as text: ids, counts and times with an offset, some of them broken."""
    key, second = F.col("id"), "yyyy-MM-dd HH:mm:ss"
    raw = view(spark, sf, "park_raw")
    text = raw.select(
        F.when(key % 101 == 0, "0").when(key % 103 == 0, "x").otherwise(key.cast("string")).alias("id"),
        F.when(key % 107 == 0, "4.5").otherwise(F.col("occupied_spaces").cast("string")).alias("occupied_spaces"),
        F.when(key % 109 == 0, "").otherwise(F.col("total_spaces").cast("string")).alias("total_spaces"),
        F.concat(F.date_format("observed_at", second), F.when(key % 113 == 0, "").otherwise("+00")).alias("observed_at"),
        F.concat(F.date_format("collected_at", second), F.when(key % 127 == 0, " UTC").when(key % 2 == 0, "Z").otherwise("+09:00")).alias("collected_at"),
    )
    return quality.violations(text, scan.parking_text_rules(), F.col("id")).select("rule", "n")


@register
def passenger_domain(spark, sf):
    """The rule checks on forecasts that break some of them."""
    batch = F.col("batch_id")
    broken = view(spark, sf, "vintages").withColumns({
        "terminal": F.when(batch % 13 == 0, "T3").otherwise(F.col("terminal")),
        "direction": F.when(batch % 17 == 0, F.lit(None)).otherwise(F.col("direction")),
        "expected_passengers": F.when(batch % 19 == 0, -1).otherwise(F.col("expected_passengers")),
    })
    return quality.violations(broken, quality.passenger_rules(), F.lpad(batch.cast("string"), 12, "0"))


@register
def flight_snapshot_rules(spark, sf):
    """The checks before flights are stored, after breaking some records and repeating others."""
    tables = context_tables(spark, sf)
    k = F.regexp_extract("flight_id", r"F(\d+)", 1).cast("bigint")
    rows = tables.flights.drop("target_date", "direction").withColumn("k", k).withColumns({
        "fid": F.when(F.col("k") % 1009 == 7, "").otherwise(F.col("flight_id")),
        "scheduled_text": F.when(F.col("k") % 1013 == 8, "202301010900").otherwise(F.col("scheduled_text")),
    })
    return payloads.flight_snapshot_violations(rows.unionByName(rows.where("k % 1019 = 9")), tables.headers).select("rule", "n")


@register
def holiday_snapshot_rules(spark, sf):
    """The checks before holidays are stored, after breaking some records and repeating others."""
    tables = context_tables(spark, sf)
    k = F.col("seq").cast("bigint")
    rows = tables.holidays.withColumns({
        "is_holiday": F.when(k % 97 == 3, "X").otherwise(F.col("is_holiday")),
        "locdate": F.when(k % 101 == 5, F.date_add("locdate", 90)).otherwise(F.col("locdate")),
    })
    return payloads.holiday_snapshot_violations(rows.unionByName(rows.where(k % 103 == 7)), tables.headers).select("rule", "n")


def order_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """A context snapshot per order: flights, or the holidays of one of twelve months with records that change at times."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("id"), F.lit("test").alias("source"), F.when(key % 5 == 0, "flights").otherwise("holidays").alias("kind"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("fetched_at"),
        F.format_string('{"month":%s,"year":2024}', F.floor(key / 7) % 12 + 1).alias("scope"),
        F.format_string('[{"n":%s}]', F.floor(key / 900) % 3).alias("records"),
    )


@register
def sink_context_if_changed(spark, sf):
    """Snapshots worth storing of the later ones: flights, and calendars that differ from the one before."""
    rows = order_snapshots(spark, sf)
    return store.snapshots_to_store(rows.where("id % 10 >= 4"), rows.where("id % 10 < 4")).select("id", "kind")


@register
def merge_context(spark, sf):
    """Context rows may not be replayed: what of a delta was stored before."""
    rows = order_snapshots(spark, sf)
    found = store.delta_violations(
        rows.where("id % 10 >= 4"), rows.where("id % 10 < 6"), ["id"], "id", 100, 1 << 62, allow_replay=False)
    return found.select("rule", "n")


# --- Models ----------------------------------------------------------------

MODEL_NUMERIC = [
    "current_ratio", "observation_age_minutes", "lag_10_ratio", "lag_60_ratio", "passengers_target_arrival", "hour_sin",
]


@register
def preprocess(spark, sf):
    """Imputed, indicated and scaled numbers of every feature row, one row per feature.

    The rows are built once: the fit reads them several times.
    """
    rows = materialize(build_features(spark, sf).select("id", *MODEL_NUMERIC), "features")
    scaling = models.fit_scaling(rows, MODEL_NUMERIC)
    scaled = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"_x_{n}").alias("value")) for n in scaling.raw()])
    long = rows.select("id", *scaling.scaled()).select("id", F.explode(scaled).alias("s")).select("id", "s.*")
    return long.withColumn("value", F.round("value", 5))


def labelled_split(spark: SparkSession, sf: str) -> DataFrame:
    """All labelled rows with their split; what a step wrote or shuffled is removed when the next ones have no use for it."""
    path = scratch_path(spark, "split")

    def step(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
        written = materialize(df, name, path)
        collect_garbage(spark)
        return written

    with scratch(spark):
        rows = step(parking(spark, sf), "parking")
        features = step(hourly.build_features(rows, view(spark, sf, "vintages")), "features")
        tagged = step(hourly.attach_targets(features, rows).where("actual_ratio is not null"), "tagged")
        return step(splits.temporal_split(tagged), "split", path)


def model_score(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Fit on the train split of all labelled rows and score on test."""
    split = labelled_split(spark, sf)
    fitted = models.fit_forecaster(
        kind, split.where("split = 'train'"), hourly.NUMERIC, hourly.CATEGORICAL, ["actual_ratio"]
    )
    scored = models.hourly_predict(split.where("split = 'test'"), fitted, "predicted_ratio")
    return rounded(scoring.forecast_metrics(scored, "actual_ratio", "predicted_ratio"))


@register
def ridge(spark, sf):
    return model_score(spark, sf, "ridge")


@register
def random_forest(spark, sf):
    return model_score(spark, sf, "random_forest")
