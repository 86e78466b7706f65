"""The four jobs end to end on small datasets."""

import math
from datetime import date, datetime, timedelta, timezone

import pytest

from pyspark.sql import functions as F

from frames import batch, every_ten, parking
from tidelot import schemas
from tidelot.functions.time import cutoff_instant
from tidelot.operators.quality import DataQualityError
from tidelot.plans import jobs, models
from tidelot.plans.nextday import BASE_NUMERIC, CONTEXT_NUMERIC
from tidelot.sources import fs, sinks
from tidelot.sources.store import CONTEXT, read_dataset


@pytest.fixture(autouse=True)
def small_forest(monkeypatch):
    monkeypatch.setattr(models, "FOREST", models.FOREST | {"numTrees": 3, "maxDepth": 4})


def dataset(spark, path, rows, passengers):
    rows.write.parquet(f"{path}/parking")
    passengers.select(*[c.split()[0] for c in schemas.PASSENGERS.split(", ")]).write.parquet(f"{path}/passengers")
    spark.createDataFrame([], CONTEXT).write.parquet(f"{path}/context")
    return str(path)


def wave(i):
    return round(50 + 25 * math.sin(i / 144 * 2 * math.pi))


def test_short_history_falls_back_to_persistence(spark, tmp_path):
    start = datetime(2026, 10, 7)
    data = dataset(spark, tmp_path / "d", parking(spark, every_ten(start, 20, wave)), batch(spark, date(2026, 10, 8)))
    out = str(tmp_path / "out")
    got = jobs.train_hourly(spark, data, out, start + timedelta(hours=4))
    assert got["status"] == "insufficient_data" and got["selected_model"] == "persistence" and got["reasons"]
    issued = spark.read.parquet(f"{out}/{got['run_dir']}/next_predictions").collect()
    assert len(issued) == 1 and issued[0].prediction_kind == "baseline" and issued[0].stale_input
    assert fs.read_json(spark, f"{out}/latest.json")["run_dir"] == got["run_dir"]
    with pytest.raises(ValueError):
        jobs.train_hourly(spark, data, out, start, horizon_minutes=10, tolerance_minutes=10)


def test_hourly_train_then_evaluate(spark, tmp_path):
    start = datetime(2026, 9, 30)
    rows = parking(spark, every_ten(start, 8 * 144 + 1, wave))
    data = dataset(spark, tmp_path / "d", rows, batch(spark, date(2026, 10, 1)))
    out, now = str(tmp_path / "out"), start + timedelta(days=8, minutes=2)
    got = jobs.train_hourly(spark, data, out, now)
    assert got["status"] == "evaluated" and not got["reasons"]
    assert set(got["test_metrics"]) == {"persistence", "ridge", "random_forest"}
    chosen = got["validation_metrics"][got["selected_model"]]["mae_percentage_points"]
    assert chosen == min(m["mae_percentage_points"] for m in got["validation_metrics"].values())
    run = f"{out}/{got['run_dir']}"
    assert {r.model for r in spark.read.parquet(f"{run}/per_lot_metrics").collect()} == set(jobs.HOURLY_CANDIDATES)
    issued = spark.read.parquet(f"{run}/next_predictions").first()
    assert issued.prediction_kind == "learned" and not issued.stale_input
    later = dataset(spark, tmp_path / "later", parking(spark, every_ten(start, 8 * 144 + 9, wave)), batch(spark, date(2026, 10, 1)))
    summary = jobs.evaluate_hourly(spark, f"{run}/next_predictions", later)
    assert summary["matched_rows"] == 1 and summary["forecast_mae_percentage_points"] < 10


def nextday_input(spark, days):
    """Readings every ten minutes and a baseline batch for every day after the first."""
    start = datetime(2026, 9, 1, 15)
    rows = parking(spark, every_ten(start, days * 144, wave), delay=timedelta(seconds=2))
    known = None
    for d in range(1, days + 1):
        one = batch(spark, date(2026, 9, 2) + timedelta(days=d), d)
        known = one if known is None else known.union(one)
    return rows, known


def test_daily_issue_is_immutable_and_scored_later(spark, tmp_path):
    rows, known = nextday_input(spark, 4)
    issue = date(2026, 9, 4)
    cutoff = cutoff_instant(issue)
    data = dataset(spark, tmp_path / "d", rows.where(F.col("collected_at") <= F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz")), known)
    out = str(tmp_path / "out")
    assert jobs.predict_daily(spark, data, out, cutoff - timedelta(minutes=1))["status"] == "skipped_before_cutoff"
    first = jobs.predict_daily(spark, data, out, cutoff + timedelta(minutes=1))
    assert first["status"] == "issued" and first["manifest"]["prediction_rows"] == 24
    assert first["manifest"]["selected_model"] == "seasonal"
    before = spark.read.parquet(f"{out}/{first['run_dir']}/predictions").collect()
    assert all(r.predicted_min_ratio <= r.predicted_ratio <= r.predicted_max_ratio for r in before)
    assert jobs.predict_daily(spark, data, out, cutoff + timedelta(minutes=9))["status"] == "already_issued"
    assert jobs.evaluate_daily(spark, data, out, cutoff + timedelta(hours=2))["status"] == "no_completed_predictions"

    full = dataset(spark, tmp_path / "full", rows, known)
    night = cutoff_instant(issue + timedelta(days=1)) + timedelta(hours=7)
    got = jobs.evaluate_daily(spark, full, out, night)["evaluated"]
    assert [(r["status"], r["matched_rows"], r["missing_rows"]) for r in got] == [("final", 24, 0)]
    assert jobs.evaluate_daily(spark, full, out, night)["status"] == "no_completed_predictions"
    assert spark.read.parquet(f"{out}/{first['run_dir']}/predictions").collect() == before
    groups = spark.read.parquet(f"{out}/evaluation_groups")
    assert groups.where("group_kind = 'hour'").count() == 24 * 3
    assert spark.read.parquet(f"{out}/persistence_metrics").count() == 3


def test_partial_coverage_is_evaluated_again(spark, tmp_path):
    rows, known = nextday_input(spark, 4)
    issue = date(2026, 9, 4)
    cutoff = cutoff_instant(issue)
    early = rows.where(F.col("collected_at") <= F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz"))
    out, data = str(tmp_path / "out"), dataset(spark, tmp_path / "d", early, known)
    jobs.predict_daily(spark, data, out, cutoff)
    night = cutoff_instant(issue + timedelta(days=1)) + timedelta(hours=7)
    half = rows.where("hour(observed_at) % 2 = 0")
    got = jobs.evaluate_daily(spark, dataset(spark, tmp_path / "half", half, known), out, night)["evaluated"]
    assert [(r["status"], r["matched_rows"], r["missing_rows"]) for r in got] == [("final", 12, 12)]
    again = jobs.evaluate_daily(spark, dataset(spark, tmp_path / "all", rows, known), out, night)["evaluated"]
    assert again[0]["coverage_pct"] == 100


def test_stale_anchor_fails_the_issue(spark, tmp_path):
    rows, known = nextday_input(spark, 4)
    cutoff = cutoff_instant(date(2026, 9, 4))
    old = rows.where(F.col("observed_at") < F.lit((cutoff - timedelta(minutes=21)).isoformat(sep=" ")).cast("timestamp_ntz"))
    data = dataset(spark, tmp_path / "d", old, known)
    with pytest.raises(DataQualityError):
        jobs.predict_daily(spark, data, str(tmp_path / "out"), cutoff)
    out = str(tmp_path / "out")
    assert sinks.issued_runs(spark, out) == {}
    assert fs.read_json(spark, f"{out}/jobs/2026-09-04.json")["status"] == "failed"


def test_failed_attempt_can_be_repeated(spark, tmp_path, monkeypatch):
    rows, known = nextday_input(spark, 4)
    cutoff = cutoff_instant(date(2026, 9, 4))
    data, out = dataset(spark, tmp_path / "d", rows.where(F.col("collected_at") <= F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz")), known), str(tmp_path / "out")

    def broken(*_):
        raise OSError("disk")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(sinks, "issue", broken)
        jobs.predict_daily(spark, data, out, cutoff)
    again = jobs.predict_daily(spark, data, out, cutoff)
    assert again["status"] == "issued" and sinks.issued_runs(spark, out) == {"2026-09-04": again["run_dir"]}
    assert fs.read_json(spark, f"{out}/jobs/2026-09-04.json")["status"] == "issued"


def test_stale_store_is_refreshed_before_a_job(spark, tmp_path):
    root, now, pulled = str(tmp_path), datetime(2026, 10, 9, 3, tzinfo=timezone.utc), []

    def pull(state):
        pulled.append(state.revision)
        first = state.cursors["parking_id"]
        delta = parking(spark, [(datetime(2026, 10, 8) + timedelta(minutes=first), 5)]).withColumn("id", F.lit(first + 1).cast("bigint"))
        moments = {k: now.isoformat() for k in ("started_at_utc", "finished_at_utc")}
        ends = {"parking_id": first + 1, "passenger_batch_id": 0}
        told = {"format_version": 2, "mode": "incremental", "timezone": "UTC", "from_cursors": dict(state.cursors),
                "to_cursors": ends, "source_instance": "db:1", "rows": {}, **moments}
        return {"parking": delta, "passengers": spark.createDataFrame([], schemas.PASSENGERS)}, told

    one = jobs.fresh_dataset(spark, root, now, pull)
    assert jobs.fresh_dataset(spark, root, now + timedelta(minutes=30), pull) == one and pulled == [0]
    two = jobs.fresh_dataset(spark, root, now + timedelta(hours=1), pull)
    assert two != one and pulled == [0, 1] and read_dataset(spark, two, "parking").count() == 2


def test_next_day_selection_needs_enough_days(spark):
    start = date(2026, 8, 1)
    rows = []
    for d in range(31):
        day = start + timedelta(days=d)
        origin = cutoff_instant(day - timedelta(days=1))
        for h in range(24):
            hour = datetime.combine(day, datetime.min.time()) + timedelta(hours=h - 9)
            wavy = math.sin(h * 2 * math.pi / 24)
            actual = 1 + 0.1 * wavy
            rows.append((day, hour, origin, hour + timedelta(hours=1), "T1 a", "T1", "long", wavy, actual, actual + 0.05, actual - 0.05))
    frame = spark.createDataFrame(
        rows, "target_date date, target_hour timestamp_ntz, origin_at timestamp_ntz, label_available_at timestamp_ntz, "
        "lot_name string, terminal string, lot_type string, hour_sin double, "
        "actual_ratio double, actual_max_ratio double, actual_min_ratio double",
    )
    filler = {c: F.lit(1.0) for c in [*BASE_NUMERIC, *CONTEXT_NUMERIC] if c != "hour_sin"}
    full = frame.withColumns(filler)
    assessment, frames = jobs.select_nextday(full)
    assert assessment["status"] == "evaluated" and assessment["context_model_eligible"]
    assert set(assessment["validation_metrics"]) >= {"ridge_context", "random_forest_context"}
    best = frames["backtest_predictions"].agg(F.max(F.abs(F.col("ridge_mean") - F.col("actual_ratio")))).first()[0]
    assert best < 0.05
    few, none = jobs.select_nextday(full.where("target_date < '2026-08-20'"))
    assert few["status"] == "insufficient_data" and few["selected_model"] == "seasonal" and not none
    no_flights, _ = jobs.select_nextday(full.withColumn("flight_arrival_available", F.lit(0)))
    assert not no_flights["context_model_eligible"] and len(no_flights["test_metrics"]) == 4
