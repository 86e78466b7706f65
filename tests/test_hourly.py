"""Hourly features, labels and splits."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from pyspark.sql import functions as F

from conftest import at
from frames import LOT, every_ten, parking
from tidelot import schemas
from tidelot.functions.time import instant
from tidelot.operators import asof, scoring, splits
from tidelot.operators.asof import Channel, asof_lookup
from tidelot.operators.quality import DataQualityError, clean_parking, dedup_first, enforce, quality_per_lot
from tidelot.operators.vintages import vintage_conflicts
from tidelot.plans import hourly


def forecasts(spark, rows):
    return spark.createDataFrame(rows, "terminal string, direction string, target_hour timestamp_ntz, fetched_at timestamp_ntz, expected_passengers int")


def test_later_revision_is_not_used(spark):
    rows = parking(spark, [(at("2026-10-08 01:00:00"), 50)])
    hour = at("2026-10-08 02:00:00")
    known = forecasts(spark, [("T1", "arrival", hour, at("2026-10-08 00:00:00"), 100),
                              ("T1", "arrival", hour, at("2026-10-08 01:01:00"), 999)])
    got = hourly.build_features(rows, known).first()
    assert got.passengers_target_arrival == 100
    assert got.latest_forecast_used_at == at("2026-10-08 00:00:00")
    assert got.passengers_now_arrival is None and got.passengers_target_departure is None


def test_conflicting_vintages_fail(spark):
    hour, seen = at("2026-10-08 02:00:00"), at("2026-10-08 00:00:00")
    bad = forecasts(spark, [("T1", "arrival", hour, seen, 1), ("T1", "arrival", hour, seen, 2)])
    with pytest.raises(DataQualityError):
        enforce(vintage_conflicts(bad))


def test_outage_gives_no_lag_and_no_label(spark):
    rows = parking(spark, [(at("2026-10-08 01:00:00"), 50), (at("2026-10-08 13:00:00"), 60)])
    features = hourly.build_features(rows, forecasts(spark, []))
    got = hourly.attach_targets(features, rows).collect()
    assert all(r.lag_10_ratio is None and r.actual_ratio is None for r in got)


def test_closed_winner_gives_null_lag_not_a_fallback(spark):
    start = at("2026-10-08 01:00:00")
    rows = parking(spark, [(start, 40), (start + timedelta(minutes=5), 0, 0), (start + timedelta(minutes=15), 60)])
    got = {r.occupied_spaces: r.lag_10_ratio for r in hourly.build_features(rows, forecasts(spark, [])).collect()}
    assert got == {40: None, 60: None}


def test_over_capacity_kept_and_closed_dropped(spark):
    rows = parking(spark, [(at("2026-10-08 01:00:00"), 110), (at("2026-10-08 01:10:00"), 10, 0)])
    got = hourly.build_features(rows, forecasts(spark, [])).collect()
    assert [r.current_ratio for r in got] == [1.1]
    assert got[0].terminal == "T1" and got[0].lot_type == "long"


def test_duplicates_go_before_clock_errors(spark):
    start = at("2026-10-08 01:00:00")
    raw = parking(spark, [(start, 1, 100, start - timedelta(minutes=1)), (start, 2), (start + timedelta(minutes=10), 3)])
    assert [r.occupied_spaces for r in clean_parking(raw).collect()] == [3]
    assert dedup_first(raw).count() == 2


def test_label_already_known_is_blanked(spark):
    """The nearest reading wins even if it is then unusable."""
    start = at("2026-10-08 01:00:00")
    target = start + timedelta(minutes=60)
    rows = parking(spark, [
        (start, 50, 100, start + timedelta(minutes=55)),
        (target + timedelta(minutes=54), 70, 100, target + timedelta(minutes=58)),
        (target + timedelta(minutes=60), 80),
    ])
    got = {r.occupied_spaces: r for r in hourly.attach_targets(hourly.origins(rows), rows).collect()}
    assert got[50].actual_ratio == 0.7


def test_reevaluation_with_later_readings(spark):
    start = at("2026-10-08 00:00:00")
    rows = parking(spark, every_ten(start, 9, lambda i: 60 if i == 8 else 50))
    issued = hourly.origins(rows).where(F.col("observed_at") == instant(start + timedelta(minutes=20))).withColumn(
        "predicted_ratio", F.lit(0.5)
    )
    checked = scoring.evaluate_hourly(hourly.attach_targets(issued, rows))
    got = scoring.eval_summary_hourly(checked).first()
    assert got.matched_rows == 1 and got.forecast_mae_percentage_points == pytest.approx(10)


def test_split_embargo_is_strict(spark):
    start = at("2026-10-01 00:00:00")
    rows = [(i, start + timedelta(minutes=10 * i), start + timedelta(minutes=10 * i + 60)) for i in range(240)]
    frame = spark.createDataFrame(rows, "i int, origin_at timestamp_ntz, label_available_at timestamp_ntz")
    got = {r.split: r for r in splits.split_sizes(splits.temporal_split(frame)).collect()}
    # Rows whose label arrives at or after the next boundary are left out.
    assert (got["train"].rows, got["validation"].rows, got["test"].rows) == (144 - 6, 48 - 6, 48)
    assert got["test"].first_origin_at == rows[192][1]


def test_split_boundaries_inside_one_second(spark):
    start = at("2026-10-01 00:00:00")
    times = [start + timedelta(microseconds=7 * i) for i in range(50)] + [start + timedelta(hours=3)] * 5
    frame = spark.createDataFrame([(t,) for t in times], "origin_at timestamp_ntz")
    ordered = sorted(set(times))
    got = splits.split_boundaries(frame).first()
    assert got.prediction_times == 51
    assert got.validation_start == ordered[int(51 * 0.6)] and got.test_start == ordered[int(51 * 0.8)]


def test_gap_report_crosses_buckets(spark):
    start = at("2026-10-01 00:55:00")
    rows = parking(spark, [(start, 1), (start + timedelta(minutes=10), 2), (start + timedelta(hours=5), 120), (start + timedelta(hours=5, minutes=10), 3, 0)])
    got = quality_per_lot(rows).first()
    assert (got.gaps_over_20_minutes, got.max_gap_minutes) == (1, 290.0)
    assert (got.capacity_versions, got.inactive_rows, got.over_capacity_rows) == (2, 1, 1)


def skewed_times(rng, count):
    """A third of the rows at one instant, a third in one bucket, the rest spread out."""
    base = datetime(2026, 10, 1)
    out = [base + timedelta(minutes=30)] * (count // 3)
    out += [base + timedelta(minutes=31, microseconds=rng.randrange(10_000_000)) for _ in range(count // 3)]
    return out + [base + timedelta(seconds=rng.randrange(4 * 86400)) for _ in range(count - len(out))]


@pytest.mark.parametrize(("bucket", "dense"), [("20 minutes", 8192), ("1 hour", 20), ("20 minutes", 0), (None, 8192)])
def test_asof_equals_brute_force_under_skew(spark, monkeypatch, bucket, dense):
    monkeypatch.setattr(asof, "DENSE", dense)
    rng = random.Random(3)
    history = [("a" if rng.random() < 0.8 else "b", t, i) for i, t in enumerate(skewed_times(rng, 300))]
    queries = [("a" if rng.random() < 0.8 else "c", t) for t in skewed_times(rng, 200)]
    got = asof_lookup(
        spark.createDataFrame(queries, "k string, t timestamp_ntz"),
        spark.createDataFrame(history, "k string, h timestamp_ntz, v int"),
        keys=["k"], query_time="t", history_time="h", tie="v", channels=[Channel("p", "v", ("v",))],
        bucket=bucket, following=True,
    ).collect()
    assert len(got) == len(set(queries))
    for row in got:
        before = [(h, v) for k, h, v in history if k == row.k and h <= row["at"]]
        after = [(h, v) for k, h, v in history if k == row.k and h > row["at"]]
        assert (row.p.v if row.p else None) == (max(before)[1] if before else None)
        first = min((h for h, _ in after), default=None)
        assert (row.next_p.v if row.next_p else None) == max((v for h, v in after if h == first), default=None)


@pytest.mark.parametrize("dense", [8192, 30, 0])
def test_previous_time_equals_lag(spark, monkeypatch, dense):
    monkeypatch.setattr(asof, "DENSE", dense)
    rng = random.Random(11)
    rows = sorted({("ab"[i % 3 == 0], t) for i, t in enumerate(skewed_times(rng, 400))})
    frame = spark.createDataFrame([(*r, 0) for r in rows], "k string, t timestamp_ntz, _n int").drop("_n")
    got = {(r.k, r.t): r.before for r in asof.previous_in_time(frame, keys=["k"], time="t", name="before").collect()}
    assert got == {(k, t): max((u for j, u in rows if j == k and u < t), default=None) for k, t in rows}


def test_window_groups_stay_bounded_in_a_hot_bucket(spark):
    """A hundred thousand instants of one lot inside twenty minutes."""
    instants = 100_000
    base = F.lit("2026-10-01 00:00:00").cast("timestamp_ntz")
    rows = spark.range(instants).select(
        F.lit("a").alias("k"), F.timestamp_add("MICROSECOND", F.col("id") * 11_000, base).alias("_t"), F.lit(1).alias("_tag"),
        F.timestamp_add("MICROSECOND", F.col("id") * 11_000, base).alias("_p_at"), F.col("id").alias("_p_v"))
    channels = [Channel("p", "v", ("v",))]
    width = asof.width_micros("20 minutes")
    loose, dense = asof.by_density(asof._bucketed(rows, ["k"], "_bucket", width, channels, False))
    within = asof._bucketed(dense, ["k", "_bucket"], "_part", asof.isqrt(width), channels, False)
    assert loose.isEmpty() and within.count() == instants
    sizes = within.groupBy("k", "_bucket", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] <= 8
    assert sizes.groupBy("k", "_bucket").count().agg(F.max("count")).first()[0] <= asof.isqrt(width) + 2


@pytest.mark.parametrize("dense", [8192, 2])
def test_rows_without_a_time_are_in_no_bucket(spark, monkeypatch, dense):
    monkeypatch.setattr(asof, "DENSE", dense)
    start = at("2026-10-08 01:00:00")
    times = [start + timedelta(minutes=m) for m in (0, 1, 2, 3, 30)]
    shape = "k string, t timestamp_ntz, v int"
    history = spark.createDataFrame([("a", t, i) for i, t in enumerate(times)] + [("a", None, 99), (None, start, 98)], shape)
    asked = spark.createDataFrame([("a", t, 0) for t in (times[2], times[4])] + [("a", None, 0), (None, start, 0)], shape)
    got = asof_lookup(
        asked, history, keys=["k"], query_time="t", history_time="t", tie="v", channels=[Channel("past", "v", ("v",))],
        following=True,
    ).collect()
    assert sorted((r.k, r.at, r.past.v, r.next_past and r.next_past.v) for r in got) == [("a", times[2], 2, 3), ("a", times[4], 4, None)]


def test_lookups_share_the_shuffle_of_the_merge(spark):
    """The instants merged from queries and history are shuffled once for all uses of them, but for one without carried columns."""
    rows = parking(spark, every_ten(at("2026-10-08 01:00:00"), 12, lambda i: i))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in (
            hourly.asof_lags(rows), hourly.nearest_labels(hourly.origins(rows), rows))]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    merges = [sum("hashpartitioning(lot_name" in line and ", _t#" in line and "Reused" not in line for line in p.splitlines()) for p in plans]
    assert merges == [2, 2]


def test_nearest_label_equals_merge_asof(spark):
    rng = random.Random(5)
    base = datetime(2026, 10, 1)
    seen = sorted({base + timedelta(seconds=rng.randrange(36000)) for _ in range(250)})
    rows = parking(spark, [(t, rng.randrange(120), rng.choice([0, 100, 120])) for t in seen])
    records = hourly.origins(rows)
    got = hourly.nearest_labels(records, rows).toPandas()
    truth = rows.where("total_spaces > 0").toPandas().sort_values("observed_at")
    want = pd.merge_asof(
        got[["requested_target_at"]].sort_values("requested_target_at"), truth, left_on="requested_target_at",
        right_on="observed_at", direction="nearest", tolerance=pd.Timedelta(minutes=10),
    )
    got = got.sort_values("requested_target_at").reset_index(drop=True)
    assert got.actual_observed_at.equals(want.observed_at.astype(got.actual_observed_at.dtype))


def test_tie_goes_to_the_earlier_reading(spark):
    start = at("2026-10-08 01:00:00")
    target = start + timedelta(minutes=60, seconds=30)
    rows = parking(spark, [(start, 50), (target - timedelta(minutes=10), 60), (target + timedelta(minutes=10), 70)])
    got = hourly.nearest_labels(hourly.origins(rows).where("occupied_spaces = 50"), rows).first()
    assert got.actual_ratio == 0.6


def test_features_do_not_change_when_later_rows_arrive(spark):
    start = at("2026-10-08 00:00:00")
    rows = every_ten(start, 12, lambda i: 40 + i)
    early, late = parking(spark, rows[:8]), parking(spark, rows)
    known = forecasts(spark, [])
    want = {r.id: r for r in hourly.build_features(early, known).collect()}
    got = {r.id: r for r in hourly.build_features(late, known).collect() if r.id in want}
    assert got == want


def test_lot_words_follow_their_order(spark):
    frame = spark.createDataFrame([("T2 장기 단기",), ("P9 예약",), (LOT,)], "lot_name string")
    got = frame.select(hourly.lot_type(F.col("lot_name")).alias("t"), hourly.lot_terminal(F.col("lot_name")).alias("k")).collect()
    assert [tuple(r) for r in got] == [("short", "T2"), ("reservation", "unknown"), ("long", "T1")]


def test_schema_of_readings(spark):
    assert parking(spark, [(at("2026-10-08 01:00:00"), 1)]).schema.simpleString().count("timestamp_ntz") == 2
    assert schemas.PARKING_CSV[0] == "id"
