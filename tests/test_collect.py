"""Landed responses end to end into the store."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelot.operators.quality import DataQualityError
from tidelot.plans import collect
from tidelot.session import scratch, scratch_path
from tidelot.sources import store
from tidelot.streaming import flows

SEEN = datetime(2026, 10, 8, 8, 10)


def response(items, total=None):
    body = {"header": {"resultCode": "00"}, "body": {"totalCount": len(items) if total is None else total, "items": items}}
    return json.dumps({"response": body}, ensure_ascii=False)


def reading(minute, count=5):
    return {"floor": "T1 단기", "parking": str(count), "parkingarea": "100", "datetm": f"202610081{minute // 60}{minute % 60:02}00.000"}


PAGES = "request_id bigint, page int, payload string, fetched_at timestamp_ntz"


def test_readings_are_stored_once(spark, tmp_path):
    root = str(tmp_path)
    pages = spark.createDataFrame([
        (1, 1, response([reading(0), reading(10)], 3), SEEN), (1, 2, response([reading(20)], 3), SEEN),
        (2, 1, response([reading(20, 9)]), SEEN + timedelta(minutes=10)),
    ], PAGES)
    assert collect.collect_readings(spark, root, pages) == 3
    assert collect.collect_readings(spark, root, pages) == 0
    rows = store.read_table(spark, root, "parking").orderBy("observed_at").collect()
    assert [r.occupied_spaces for r in rows] == [5, 5, 5] and len({r.id for r in rows}) == 3
    more = spark.createDataFrame([(3, 1, response([reading(30)]), SEEN)], PAGES)
    assert collect.collect_readings(spark, root, more) == 1
    state = store.load_state(spark, root)
    assert state.rows["parking"] == 4 and state.revision == 2 and state.cursors["parking_id"] > max(r.id for r in rows)
    for bad in (response([reading(40)], 2), response([reading(40, -1)]), "no json"):
        with pytest.raises(DataQualityError):
            collect.collect_readings(spark, root, spark.createDataFrame([(4, 1, bad, SEEN)], PAGES))
    assert store.load_state(spark, root) == state


def test_readings_from_a_stream(spark, tmp_path):
    root, landed = str(tmp_path / "store"), str(tmp_path / "landed")
    spark.createDataFrame([(1, 1, response([reading(0), reading(10)]), SEEN)], PAGES).write.parquet(landed)
    for _ in range(2):
        stream = flows.read_files(spark, landed, PAGES)
        flows.drain_batches(stream, collect.collect_into(spark, collect.collect_readings, root), scratch_path(spark, "checkpoint"))
    assert store.load_state(spark, root).rows["parking"] == 2


def forecast(day, value):
    return [{"adate": day, "atime": f"{h:02}_{h + 1:02}", "t1egsum1": str(value), "t1dgsum1": "1", "t2egsum1": "2", "t2dgsum2": "3"} for h in range(24)]


def test_forecasts_are_stored_when_they_change(spark, tmp_path):
    root, kind = str(tmp_path), PAGES + ", day_offset int"
    land = lambda n, value, day="20261009": spark.createDataFrame([(n, 1, response(forecast(day, value)), SEEN + timedelta(minutes=n), 1)], kind)
    assert collect.collect_forecasts(spark, root, land(1, 10), "baseline") == 96
    assert collect.collect_forecasts(spark, root, land(2, 10), "recheck") == 0
    assert collect.collect_forecasts(spark, root, land(3, 11), "recheck") == 96
    changed = store.read_table(spark, root, "passengers").select("batch_id", "phase", "changed_count").distinct().orderBy("batch_id").collect()
    assert [(r.phase, r.changed_count) for r in changed][1] == ("recheck", 24)
    for bad, phase in ((land(4, 12, "20261010"), "recheck"), (land(4, "1.5"), "recheck"), (land(4, 12), "again"), (land(4, 12).union(land(5, 12)), "recheck")):
        with pytest.raises(DataQualityError):
            collect.collect_forecasts(spark, root, bad, phase)
    assert store.load_state(spark, root).rows["passengers"] == 192


def test_a_backlog_of_several_runs_is_stored(spark, tmp_path):
    root, kind = str(tmp_path), PAGES + ", day_offset int, run int"
    land = lambda n, value, run: spark.createDataFrame(
        [(n, 1, response(forecast("20261009", value)), SEEN + timedelta(minutes=n), 1, run)], kind)
    with pytest.raises(DataQualityError):
        collect.collect_forecasts(spark, root, land(1, 10, 7).union(land(2, 11, 7)), "recheck")
    backlog = land(5, 12, 9).union(land(1, 10, 7)).union(land(3, 10, 8))
    assert collect.collect_forecasts(spark, root, backlog, "recheck") == 192
    kept = store.read_table(spark, root, "passengers").select("batch_id", "fetched_at", "changed_count").distinct().orderBy("batch_id").collect()
    # The second run of the backlog changed nothing; numbers follow the requests.
    assert [(r.batch_id, r.fetched_at) for r in kept] == [(1, SEEN + timedelta(minutes=1)), (3, SEEN + timedelta(minutes=5))]


def test_requests_are_numbered_without_gaps(spark):
    requests = spark.range(0, 3000, 3, 7).select(F.col("id").alias("request_id"))
    with scratch(spark):
        got = sorted(tuple(r) for r in collect._numbered(requests.union(requests), F.lit(10)).collect())
    assert got == [(3 * i, 11 + i) for i in range(1000)]


def test_snapshots_are_stored_when_they_change(spark, tmp_path):
    root, kind = str(tmp_path), "request_id bigint, source string, kind string, fetched_at timestamp_ntz, scope string, records string"
    flight = {"fid": "1", "flightId": "KE1", "terminalid": "P01", "scheduleDateTime": "202610091000"}
    day = {"locdate": "20261009", "isHoliday": "Y", "seq": "1", "dateName": "한글날"}
    scopes = {"flights": {"target_date": "2026-10-09", "direction": "arrival", "time_basis": "scheduled"}, "holidays": {"year": 2026, "month": 10}}
    land = lambda n, what, *records: spark.createDataFrame([(n, "api", what, SEEN, json.dumps(scopes[what]), json.dumps(records))], kind)
    assert [collect.collect_snapshots(spark, root, x) for x in (
        land(1, "flights", flight).union(land(2, "holidays", day)), land(3, "flights", flight), land(4, "holidays", day), land(5, "holidays")
    )] == [2, 1, 0, 1]
    state = store.load_state(spark, root)
    assert state.rows["context"] == 4
    for bad in (land(6, "flights", flight | {"fid": ""}), land(6, "flights", flight, flight), land(6, "flights", flight | {"scheduleDateTime": "202610081000"}),
                land(6, "holidays", day | {"isHoliday": "?"}), land(6, "holidays", day | {"locdate": "20261109"})):
        with pytest.raises(DataQualityError):
            collect.collect_snapshots(spark, root, bad)
    assert store.load_state(spark, root) == state
