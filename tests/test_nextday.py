"""Hourly truth, batches, day frames and their splits."""

from datetime import date, datetime, timedelta

import pytest

from pyspark.sql import functions as F

from conftest import at
from frames import LOT, batch, every_ten, no_context, parking
from tidelot import schemas
from tidelot.functions.time import DEFAULT_CUTOFF, cutoff_instant, instant
from tidelot.operators import scoring, splits, truth, vintages
from tidelot.plans import baselines, nextday

HOUR = at("2026-10-08 01:00:00")


def test_six_slots(spark):
    rows = parking(spark, every_ten(HOUR, 6, lambda i: 90 + i))
    got = truth.hourly_truth(rows).first()
    assert (got.actual_ratio, got.actual_max_ratio, got.actual_min_ratio) == pytest.approx((0.925, 0.95, 0.90))
    assert got.observation_slots == 6


def test_three_slots_are_not_enough_but_keep_their_row(spark):
    got = truth.hourly_truth(parking(spark, every_ten(HOUR, 3, lambda i: 90 + i))).first()
    assert got.actual_ratio is None and got.observation_slots == 3 and got.label_available_at is not None


def test_extremes_use_every_reading_and_exceed_one(spark):
    extra = [(HOUR + timedelta(minutes=1), 150)]
    got = truth.hourly_truth(parking(spark, every_ten(HOUR, 6, lambda i: 90) + extra)).first()
    assert got.actual_max_ratio == 1.5 and got.observation_slots == 6


def test_copies_do_not_fill_slots(spark):
    copies = [(HOUR, 90 + i, 100, HOUR + timedelta(seconds=30 + i)) for i in range(6)]
    got = truth.hourly_truth(parking(spark, copies)).first()
    assert got.observation_slots == 1 and got.actual_ratio is None


def test_unfinished_hours_and_late_rows_are_unknown(spark):
    rows = every_ten(HOUR, 6, lambda i: 90)
    rows[5] = (rows[5][0], 200, 100, HOUR + timedelta(hours=5))
    frame = parking(spark, rows)
    running = truth.hourly_truth(frame, instant(HOUR + timedelta(minutes=59))).first()
    ended = truth.hourly_truth(frame, instant(HOUR + timedelta(hours=1))).first()
    later = truth.hourly_truth(frame, instant(HOUR + timedelta(hours=6))).first()
    assert running.actual_ratio is None and running.observation_slots == 5
    assert ended.actual_max_ratio == 0.9 and later.actual_max_ratio == 2.0


def test_cutoff_is_local(spark):
    assert cutoff_instant(date(2026, 10, 8)) == at("2026-10-08 08:15:00")


ISSUE = date(2026, 10, 8)
CUTOFF = cutoff_instant(ISSUE)


def three_days(spark, lot=LOT):
    start = datetime(2026, 10, 5, 15)
    return parking(spark, every_ten(start, 3 * 144, lambda i: 90 + i % 30), lot=lot, delay=timedelta(seconds=2))


def issues(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "issue_date date")


def test_incomplete_stale_and_late_batches(spark):
    day = ISSUE + timedelta(days=1)
    complete = batch(spark, day, 1, fetched=CUTOFF - timedelta(minutes=5))
    cut = batch(spark, day, 2, fetched=CUTOFF - timedelta(minutes=1), drop=1)
    late = batch(spark, day, 3, fetched=CUTOFF + timedelta(seconds=1))
    old = batch(spark, day, 4, fetched=CUTOFF - timedelta(minutes=6))
    got = vintages.forecast_batches(complete.union(cut).union(late).union(old), DEFAULT_CUTOFF).collect()
    assert [r.forecast_batch_id for r in got] == [1]
    assert vintages.forecast_batches(old.union(late).union(cut), DEFAULT_CUTOFF).count() == 0
    assert vintages.forecast_batches(old, DEFAULT_CUTOFF, None).count() == 1


def test_off_grid_keys_make_a_batch_incomplete(spark):
    day = ISSUE + timedelta(days=1)
    shifted = batch(spark, day).withColumn("target_hour", F.when(
        F.col("target_hour") == instant(datetime(2026, 10, 8, 15)), F.col("target_hour") + F.expr("interval 1 minute")
    ).otherwise(F.col("target_hour")))
    assert vintages.forecast_batches(shifted, DEFAULT_CUTOFF).count() == 0


def build(spark, rows=None, forecasts=None, **options):
    forecasts = forecasts or batch(spark, ISSUE + timedelta(days=1), T1_arrival_0=7, T1_arrival_1=11, T1_departure_23=5)
    rows = rows if rows is not None else three_days(spark)
    return nextday.build_days(rows, forecasts.drop("target_date"), no_context(spark), issues(spark, ISSUE), **options)


def test_day_frame(spark):
    got = build(spark).orderBy("target_hour").collect()
    assert len(got) == 24
    first, last = got[0], got[23]
    assert first.target_hour == at("2026-10-08 15:00:00") and first.lead_hours == 6.75
    assert first.arrival == 7 and first.arrival_previous_2h == 0 and got[2].arrival_previous_2h == 18
    assert last.departure_next_2h == 0 and got[22].departure_next_2h == 5
    assert first.arrival_cumulative == 7 and last.arrival_cumulative == last.arrival_daily == 7 + 11 + 22 * 100
    assert first.anchor_age_minutes == pytest.approx(5.0)
    # Hours of the issue day that end after the cutoff cannot serve as history yet.
    assert [r.previous_day_same_hour is not None for r in got] == [h < 17 for h in range(24)]
    assert all(r.holiday_available == 0 and r.flight_arrival is None for r in got)


def test_rows_after_the_cutoff_change_nothing(spark):
    after = parking(spark, every_ten(CUTOFF + timedelta(seconds=1), 20, lambda i: 1))
    late = parking(spark, [(CUTOFF - timedelta(minutes=1), 1, 100, CUTOFF + timedelta(minutes=1))])
    want = {r.target_hour: r for r in build(spark).collect()}
    got = {r.target_hour: r for r in build(spark, three_days(spark).where(
        F.col("collected_at") <= instant(CUTOFF)).union(after).union(late)).collect()}
    assert got == want


def test_reading_known_exactly_at_the_cutoff_is_the_anchor(spark):
    edge = parking(spark, [(CUTOFF - timedelta(seconds=9), 42, 100, CUTOFF)])
    before = three_days(spark).where(F.col("collected_at") < instant(CUTOFF))
    assert build(spark, before.union(edge)).first().current_ratio == 0.42


def test_closed_anchor_drops_the_lot(spark):
    closed = parking(spark, [(CUTOFF - timedelta(minutes=1), 0, 0)])
    rows = three_days(spark).where(F.col("collected_at") < instant(CUTOFF - timedelta(minutes=2)))
    assert build(spark, rows.union(closed)).count() == 0


def test_reasons_for_skipped_days(spark):
    forecasts = batch(spark, ISSUE + timedelta(days=1)).drop("target_date")
    empty = no_context(spark)

    def reason(rows, known, issue=ISSUE):
        found = nextday.skipped_days(rows, known, empty, issues(spark, issue)).first()
        return found and found.reason

    rows = three_days(spark)
    assert reason(rows, forecasts) is None
    assert "batch" in reason(rows, forecasts.where("batch_id = 9"))
    assert "observations" in reason(rows.where("id < 0"), forecasts)
    assert "X9" in reason(rows.union(three_days(spark, lot="X9")), forecasts)
    assert build(spark, rows.union(three_days(spark, lot="X9"))).count() == 0


def test_training_labels_and_anchor_age(spark):
    day = ISSUE
    forecasts = batch(spark, day).drop("target_date")
    as_of = instant(datetime(2026, 10, 8, 15))
    rows, skipped = nextday.build_training(three_days(spark), forecasts, no_context(spark), as_of)
    got = rows.collect()
    assert skipped.count() == 0 and len(got) == 24
    assert all(r.label_available_at is not None and r.issue_date == day - timedelta(days=1) for r in got)
    stale = three_days(spark).where(
        (F.col("collected_at") < instant(cutoff_instant(day - timedelta(days=1)) - timedelta(minutes=21)))
        | (F.col("collected_at") > instant(cutoff_instant(day - timedelta(days=1))))
    )
    assert nextday.build_training(stale, forecasts, no_context(spark), as_of)[0].count() == 0


def labelled_days(spark, days, lots=2):
    start = date(2026, 9, 1)
    rows = []
    for d in range(days):
        day = start + timedelta(days=d)
        origin = cutoff_instant(day - timedelta(days=1))
        for h in range(24):
            hour = datetime.combine(day, datetime.min.time()) + timedelta(hours=h - 9)
            rows += [(f"T1 {lot}", day, hour, origin, hour + timedelta(hours=1)) for lot in range(lots)]
    return spark.createDataFrame(
        rows, "lot_name string, target_date date, target_hour timestamp_ntz, origin_at timestamp_ntz, label_available_at timestamp_ntz"
    )


def test_day_split_embargo_is_inclusive(spark):
    frame = labelled_days(spark, 30)
    got = splits.day_split(frame).groupBy("split").agg(F.count_distinct("target_date").alias("d"), F.count("*").alias("n")).collect()
    by = {r.split: (r.d, r.n) for r in got}
    # The last label days before a boundary are known only after the first held-out issue.
    assert by["test"] == (7, 7 * 48)
    assert by["train"] == (16, 15 * 48 + 2 * 17)
    assert by["validation"] == (7, 6 * 48 + 2 * 17)


def test_revisions(spark):
    day = ISSUE + timedelta(days=1)
    later = [CUTOFF + timedelta(hours=h) for h in (1, 2, 3)]
    rows = batch(spark, day, 1)
    rows = rows.union(batch(spark, day, 2, fetched=later[0]).withColumn("phase", F.lit("recheck")))
    rows = rows.union(batch(spark, day, 3, fetched=later[1], T2_arrival_4=1).withColumn("phase", F.lit("recheck")))
    rows = rows.union(batch(spark, day, 4, fetched=later[2], T2_arrival_4=1))
    rows = rows.withColumn("target_date", F.when(F.col("batch_id") != 3, F.col("target_date")))
    counts = {r.batch_id: r.changed_count for r in vintages.changed_count(rows).collect()}
    assert counts == {1: 96, 2: 0, 3: 1, 4: 0}
    assert sorted(r.batch_id for r in vintages.revision_filter(rows).collect()) == [1, 3, 4]


def test_baselines_and_order(spark):
    frame = spark.createDataFrame(
        [(0.5, None, 0.7, None, 0.6, 0.2, None), (0.5, 0.4, 0.7, 0.3, 0.6, None, None)],
        "current_ratio double, previous_week_same_hour double, previous_day_same_hour double, previous_week_max double, "
        "previous_day_max double, previous_week_min double, previous_day_min double",
    )
    got = baselines.with_forecast(frame, baselines.seasonal()).select(*scoring.PREDICTED.values()).collect()
    assert [tuple(r) for r in got] == [(0.7, 0.7, 0.2), (0.4, 0.4, 0.4)]
    negative = frame.withColumns({"m": F.lit(-0.2), "x": F.lit(-0.4), "n": F.lit(0.3)})
    got = baselines.with_forecast(negative, baselines.learned({"mean": "m", "max": "x", "min": "n"})).first()
    assert (got.predicted_ratio, got.predicted_max_ratio, got.predicted_min_ratio) == (0.0, 0.0, 0.0)


def test_metrics_with_null_group(spark):
    frame = spark.createDataFrame(
        [("T1 a", HOUR, 0.95, 0.95, 0.9, 0.85, 0.95, 0.9, 1), ("T1 a", HOUR, 0.5, 0.6, 0.4, 0.5, 0.6, 0.4, None)],
        "lot_name string, target_hour timestamp_ntz, actual_ratio double, actual_max_ratio double, actual_min_ratio double, "
        "predicted_ratio double, predicted_max_ratio double, predicted_min_ratio double, is_holiday int",
    )
    got = {(r.group_kind, r.group_value, r.statistic): r for r in scoring.metrics_by_group(frame).collect()}
    assert got["is_holiday", None, "mean"].rows == 1 and got["is_holiday", "1", "mean"].rows == 1
    whole = got["all", "all", "mean"]
    assert (whole.rows, whole.busy_f1, whole.actual_busy_rows) == (2, 0.0, 1)
    assert whole.mae_percentage_points == pytest.approx(5.0) and got["all", "all", "max"].busy_f1 == 1.0
    assert got["hour", "10", "mean"].rows == 2


def test_evaluation_counts(spark):
    hours = [HOUR + timedelta(hours=i) for i in range(3)]
    issued = spark.createDataFrame(
        [(ISSUE, ISSUE, LOT, h, 0.5, 0.5, 0.5) for h in hours],
        "issue_date date, target_date date, lot_name string, target_hour timestamp_ntz, "
        "predicted_ratio double, predicted_max_ratio double, predicted_min_ratio double",
    )
    rows = parking(spark, every_ten(hours[0], 6, lambda i: 60) + every_ten(hours[1], 2, lambda i: 60))
    as_of = instant(hours[2] + timedelta(minutes=30))
    checked = scoring.evaluate_nextday(issued, truth.hourly_truth(rows, as_of), as_of)
    got = scoring.eval_summary_nextday(checked, as_of).first()
    assert (got.status, got.matched_rows, got.missing_rows, got.pending_rows) == ("partial", 1, 1, 1)
    final = scoring.eval_summary_nextday(checked, instant(hours[2] + timedelta(hours=1))).first()
    assert final.status == "final" and final.coverage_pct == pytest.approx(100 / 3)


def test_choice_ties_go_to_the_earlier_model(spark):
    errors = spark.createDataFrame([("ridge", 1.0), ("seasonal", 1.0), ("persistence", 2.0)], "model string, error double")
    assert scoring.argmin_model(errors, ["persistence", "seasonal", "ridge"]).first()[0] == "seasonal"


def test_issue_days_reach_the_scans(spark, tmp_path):
    start = datetime(2026, 9, 1)
    parking(spark, every_ten(start, 30, lambda i: i)).write.parquet(f"{tmp_path}/p")
    stored = spark.read.schema(schemas.PARKING).parquet(f"{tmp_path}/p")
    days = (date(2026, 9, 20), date(2026, 9, 21))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    history = plan(nextday.history_readings(stored, days))
    # The first target day is the 21st and history starts eight days before it, at local midnight.
    pushed = history.split("PushedFilters: ")[1]
    assert ">= 2026-09-12 15:00:00" in history and "< 2026-09-22 15:00:00" in history and "GreaterThanOrEqual(observed_at" in pushed
    visible = plan(nextday.known_readings(stored, days, "17:15"))
    assert "<= 2026-09-21 08:15:00" in visible and "LessThanOrEqual(collected_at" in visible.split("PushedFilters: ")[1]
    assert nextday.history_readings(stored, None).count() == 0
