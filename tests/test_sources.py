"""Payload parsing, strict readers and the append-only store."""

import json
import re
from datetime import date, datetime, timedelta, timezone

import pytest

from pyspark.sql import functions as F

from conftest import at
from frames import batch, parking
from tidelot import schemas
from tidelot.functions.passengers import whole_count
from tidelot.operators.quality import DataQualityError, enforce
from tidelot.sources import fs, payloads, scan, sinks, store

NOW = datetime(2026, 10, 9, 3, tzinfo=timezone.utc)


def page(items, total, code="00", wrap=True):
    body = {"header": {"resultCode": code}, "body": {"totalCount": total, "items": items}}
    return json.dumps({"response": body} if wrap else body, ensure_ascii=False)


def pages(spark, rows):
    return spark.createDataFrame(rows, "request_id int, page int, payload string")


ITEM = {"floor": " T1 단기 ", "parking": "110", "parkingarea": 100, "datetm": "20261008102000.804"}


def test_item_shapes_and_totals(spark):
    frame = pages(spark, [
        (1, 1, page([ITEM, ITEM], 3)), (1, 2, page({"item": ITEM}, 3, wrap=False)),
        (2, 1, page({"item": [ITEM]}, "1")), (3, 1, page("", 0)),
    ])
    found = payloads.envelope(frame)
    assert payloads.page_violations(found.where("request_id < 3"), allow_empty=False).count() == 0
    assert payloads.page_violations(found, allow_empty=True).count() == 0
    assert [r.rule for r in payloads.page_violations(found, allow_empty=False).collect()] == ["no items"]
    assert payloads.parse_parking_payload(frame).groupBy("request_id").count().count() == 2


def test_bad_pages(spark):
    frame = pages(spark, [
        (1, 1, page([ITEM], 2)), (2, 1, page([ITEM], 1, code="99")), (3, 1, page([ITEM], 2)), (3, 2, page([ITEM], 3)),
        (4, 1, "not json"),
    ])
    got = {r.rule: r.n for r in payloads.page_violations(payloads.envelope(frame), allow_empty=True).collect()}
    assert got["items differ from the total count"] == 2
    assert got["request failed"] == 2 and got["total count changed between pages"] == 1
    assert got["total count missing"] == 1


def test_pages_have_no_limit_but_the_given_one(spark):
    frame = payloads.envelope(pages(spark, [(1, n, page([ITEM], 60)) for n in range(1, 61)]))
    assert payloads.page_violations(frame, allow_empty=False).count() == 0
    limited = payloads.page_violations(frame, allow_empty=False, most_pages=payloads.CONTEXT_PAGES)
    assert [r.rule for r in limited.collect()] == ["too many pages"]


def test_whole_counts_look_at_every_digit(spark):
    texts = {"12": 12, " 12.000 ": 12, "12.0000004": None, "12.5": None, "-4": None, "-0": 0, "1E2": 100, "1.25e1": None, "+7": 7,
             "": None, "x": None, "007": 7, "99999999999": None, None: None}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(whole_count(F.col("t"))).collect()
    assert [r[0] for r in got] == list(texts.values())


def test_normalize_parking(spark):
    rows = [ITEM, ITEM | {"floor": "  "}, ITEM | {"parking": "-1"}, ITEM | {"datetm": "20261308102000.8"}, ITEM | {"datetm": "20261008102000"}]
    frame = pages(spark, [(1, 1, page(rows, 5))])
    got = payloads.normalize_parking(payloads.parse_parking_payload(frame)).orderBy("pos").collect()
    assert [r.is_valid for r in got] == [True, False, False, False, False]
    assert got[0].lot_name == "T1 단기" and got[0].occupied_spaces == 110
    assert got[0].observed_at == datetime(2026, 10, 8, 1, 20, 0, 804000)


def test_normalize_passenger(spark):
    def item(atime, **extra):
        return {"adate": "20261009", "atime": atime, "t1egsum1": "10", "t1dgsum1": "1.0", "t2egsum1": 3, "t2dgsum2": "4"} | extra

    rows = [item("00_01"), item("23_24"), item("23_0"), item("10_12"), item("11_12", t2dgsum2="1.5"), item("합계", adate="합계")]
    body = page(rows, 6)
    frame = spark.createDataFrame(
        [(1, at("2026-10-08 08:10:00"), 1, body), (2, at("2026-10-07 08:10:00"), 1, body)],
        "request_id int, fetched_at timestamp_ntz, day_offset int, payload string",
    )
    items = payloads.parse_passenger_payload(frame)
    wrong = payloads.passenger_date_violations(items).collect()
    assert [(r.n, r.key) for r in wrong] == [(5, "2")]
    got = payloads.normalize_passenger(items.where("request_id = 1"))
    assert got.count() == 20 and got.where("not is_valid").count() == 5
    first = got.where("pos = 0 and terminal = 'T2' and direction = 'departure'").first()
    assert first.target_hour == at("2026-10-08 15:00:00") and first.expected_passengers == 4


def test_snapshot_record_checks(spark):
    headers = spark.createDataFrame([
        (1, "s", "flights", NOW.replace(tzinfo=None), date(2026, 10, 9), "arrival", "scheduled", None, None),
        (2, "s", "holidays", NOW.replace(tzinfo=None), None, None, None, 2026, 10),
    ], schemas.CONTEXT_HEADERS)
    flights = spark.createDataFrame([
        (1, 0, "f1", "KE1", "", "", "P01", "202610090900", ""), (1, 1, "f1", "KE1", "", "", "P01", "202610090900", ""),
        (1, 2, "", "KE2", "", "", "P01", "202610100900", ""),
    ], schemas.FLIGHTS)
    got = {r.rule: r.n for r in payloads.flight_snapshot_violations(flights, headers).collect()}
    assert got == {"flight has no identity": 1, "flight listed twice": 1, "scheduled on another day than its snapshot": 1}
    holidays = spark.createDataFrame([
        (2, 0, date(2026, 10, 3), "Y", "1", "a"), (2, 1, date(2026, 10, 3), "Y", "1", "a"), (2, 2, date(2026, 11, 3), "?", "1", "b"),
    ], schemas.HOLIDAYS)
    got = {r.rule: r.n for r in payloads.holiday_snapshot_violations(holidays, headers).collect()}
    assert got == {"repeated holiday": 1, "holiday outside its month": 1, "holiday without a Y or N flag": 1}


@pytest.mark.parametrize("kind", ["flights", "holidays"])
def test_snapshot_records_are_dealt_by_identity(spark, kind):
    """Few snapshots hold all records; a header listed twice repeats its records and asks for each of its days."""
    stamp = NOW.replace(tzinfo=None)
    headers = spark.createDataFrame([
        (1, "s", "flights", stamp, date(2026, 10, 9), "arrival", "scheduled", None, None),
        (1, "s", "flights", stamp, date(2026, 10, 10), "arrival", "scheduled", None, None),
        (2, "s", "holidays", stamp, None, None, None, 2026, 10), (2, "s", "holidays", stamp, None, None, None, 2026, 10),
    ], schemas.CONTEXT_HEADERS)
    if kind == "flights":
        rows = spark.createDataFrame([(1, 0, "f1", "KE1", "", "", "P01", "202610090900", "")], schemas.FLIGHTS)
        found = payloads.flight_snapshot_violations(rows, headers)
        want = {"flight listed twice": (1, "1"), "scheduled on another day than its snapshot": (1, "1")}
    else:
        rows = spark.createDataFrame([(2, 0, date(2026, 10, 3), "Y", "1", "a")], schemas.HOLIDAYS)
        found = payloads.holiday_snapshot_violations(rows, headers)
        want = {"repeated holiday": (1, "2")}
    assert {r.rule: (r.n, r.key) for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    identity = {"flights": ("snapshot_id", "fid", "flight_id"), "holidays": ("snapshot_id", "locdate", "seq", "date_name")}[kind]
    assert re.search("hashpartitioning\\(" + ", ".join(rf"{c}#\d+L?" for c in identity) + ", 4\\)", plan)


PARKING_CSV = """id,source,lot_name,observed_at,collected_at,occupied_spaces,total_spaces
1,s,"T1 단기
주차장",2026-10-08 01:00:00+00,2026-10-08T10:00:30+09:00,4512,4404
"""


def test_strict_parking_csv(spark, tmp_path):
    good = tmp_path / "parking.csv"
    good.write_text(PARKING_CSV, encoding="utf-8")
    row = scan.scan_parking(spark, str(tmp_path)).first()
    assert row.lot_name == "T1 단기\n주차장" and row.observed_at == at("2026-10-08 01:00:00")
    assert row.collected_at == at("2026-10-08 01:00:30") and row.occupied_spaces == 4512
    for i, (old, new) in enumerate([("+00,", ","), ("4512", "45.5"), ("\n1,", "\n0,")]):
        bad = tmp_path / f"bad{i}.csv"
        bad.write_text(PARKING_CSV.replace(old, new), encoding="utf-8")
        with pytest.raises(DataQualityError):
            scan.delta_parking(spark, str(bad))
    for i, (old, new) in enumerate([("lot_name", "lot"), (",4404", "")]):
        bad = tmp_path / f"shape{i}.csv"
        bad.write_text(PARKING_CSV.replace(old, new), encoding="utf-8")
        with pytest.raises(Exception):
            scan.delta_parking(spark, str(bad)).collect()


def test_context_csv_is_flattened(spark, tmp_path):
    assert [f.count() for f in scan.scan_context(spark, str(tmp_path))] == [0, 0, 0]
    records = [{"fid": str(i), "flightId": f"KE{i}", "scheduleDateTime": "202610090900", "terminalid": "P01", "codeshare": "Master"} for i in range(2000)]
    days = [{"locdate": 20261009, "isHoliday": "Y", "dateName": "한글날", "seq": 1}]
    scope = {"target_date": "2026-10-09", "direction": "arrival", "time_basis": "scheduled"}

    def quoted(value):
        return '"' + json.dumps(value, ensure_ascii=False).replace('"', '""') + '"'

    lines = [",".join(schemas.CONTEXT_CSV)]
    lines.append(f"1,s,flights,2026-10-08 08:10:00+00,{quoted(scope)},{quoted(records)}")
    lines.append(f"2,s,holidays,2026-10-08 08:10:00+00,{quoted({'year': 2026, 'month': 10})},{quoted(days)}")
    lines.append(f"3,s,holidays,2026-10-08 08:10:00+00,{quoted({'year': 2026, 'month': 12})},[]")
    (tmp_path / "context_snapshots.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    headers, flights, holidays = scan.scan_context(spark, str(tmp_path))
    assert (headers.count(), flights.count(), holidays.count()) == (3, 2000, 1)
    assert holidays.first().locdate == date(2026, 10, 9) and headers.where("id = 1").first().direction == "arrival"
    (tmp_path / "context_snapshots.csv").write_text("\n".join(lines).replace("[]", "{}") + "\n", encoding="utf-8")
    with pytest.raises(DataQualityError):
        scan.scan_context(spark, str(tmp_path))


def manifest(state, parking_id, batch_id, rows, **changes):
    return {
        "format_version": 2, "mode": "incremental", "timezone": "UTC", "from_cursors": dict(state.cursors),
        "to_cursors": {"parking_id": parking_id, "passenger_batch_id": batch_id}, "source_instance": "db:1",
        "rows": rows, "started_at_utc": NOW.isoformat(), "finished_at_utc": NOW.isoformat(),
    } | changes


def readings(spark, first, last):
    start = at("2026-10-08 00:00:00")
    frame = parking(spark, [(start + timedelta(minutes=i), 50 + i) for i in range(first, last + 1)])
    return frame.withColumn("id", F.col("id") + first - 1)


def forecasts(spark, number):
    return batch(spark, date(2026, 10, 9), number)


def test_sync_accumulates_and_assembles(spark, tmp_path):
    root = str(tmp_path)
    state = store.load_state(spark, root)
    with pytest.raises(DataQualityError):
        store.assemble(spark, root, NOW)
    delta = {"parking": readings(spark, 1, 5), "passengers": forecasts(spark, 1)}
    state, added = store.sync(spark, root, delta, manifest(state, 5, 1, {"parking": 5, "passengers": 96}), NOW)
    assert added == {"parking": 5, "passengers": 96} and state.revision == 1
    first = store.assemble(spark, root, NOW)
    # An empty delta moves no revision, so the dataset is reused.
    empty = {"parking": readings(spark, 1, 1).limit(0), "passengers": forecasts(spark, 1).limit(0)}
    state, added = store.sync(spark, root, empty, manifest(state, 5, 1, {"parking": 0, "passengers": 0}), NOW)
    assert sum(added.values()) == 0 and state.revision == 1 and store.assemble(spark, root, NOW) == first
    more = {"parking": readings(spark, 6, 8), "passengers": forecasts(spark, 2)}
    state, _ = store.sync(spark, root, more, manifest(state, 8, 2, {"parking": 3, "passengers": 96}), NOW)
    second = store.assemble(spark, root, NOW + timedelta(seconds=1))
    assert second != first and store.read_dataset(spark, second, "parking").count() == 8
    assert scan.resolve_latest(spark, root) == second
    assert store.store_status(state)["total_rows"] == {"parking": 8, "passengers": 192, "context": 0}


@pytest.mark.parametrize("change", [
    {"to_cursors": {"parking_id": 4, "passenger_batch_id": 1}}, {"source_instance": "db:2"}, {"source_instance": None},
    {"from_cursors": {"parking_id": 1, "passenger_batch_id": 1}}, {"mode": "full"}, {"started_at_utc": "2026-10-09T00:00:00"},
    {"to_cursors": {"parking_id": 7, "passenger_batch_id": 1, "other": 1}}, {"rows": {"parking": 1, "passengers": 0}},
    {"to_cursors": {"parking_id": 9, "passenger_batch_id": 1}},
])
def test_failed_sync_keeps_the_store(spark, tmp_path, change):
    root = str(tmp_path)
    state = store.StoreState(cursors={"parking_id": 5, "passenger_batch_id": 1}, source_instance="db:1")
    fs.write_json(spark, f"{root}/state.json", state.__dict__)
    delta = {"parking": readings(spark, 6, 7), "passengers": forecasts(spark, 1).limit(0)}
    bad = manifest(state, 7, 1, {"parking": 2, "passengers": 0}) | change
    with pytest.raises(DataQualityError):
        store.sync(spark, root, delta, bad, NOW)
    assert store.load_state(spark, root) == state


def test_all_manifest_problems_are_told(spark, tmp_path):
    state = store.StoreState(cursors={"parking_id": 5, "passenger_batch_id": 1}, source_instance="db:1")
    told = store.DeltaManifest.parse({"format_version": 2, "mode": "incremental", "timezone": "KST", "from_cursors": {}, "to_cursors": {"parking_id": True}})
    assert len(told.problems(state)) == 6
    context = manifest(state, 5, 1, {}, to_cursors={"parking_id": 5, "passenger_batch_id": 1, "context_id": 4})
    assert store.DeltaManifest.parse(context).problems(state) == []


def test_half_written_state_is_never_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    delta = {"parking": readings(spark, 1, 3), "passengers": forecasts(spark, 1)}
    first, _ = store.sync(spark, root, delta, manifest(store.StoreState(), 3, 1, {"parking": 3, "passengers": 96}), NOW)
    more = {"parking": readings(spark, 4, 5), "passengers": forecasts(spark, 2)}
    after = manifest(first, 5, 2, {"parking": 2, "passengers": 96})

    def torn(*_):
        raise OSError("the writer is gone")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(fs, "_rename", torn)
        store.sync(spark, root, more, after, NOW)
    assert store.load_state(spark, root) == first and store.read_table(spark, root, "parking").count() == 3
    second, _ = store.sync(spark, root, more, after, NOW)
    assert second.revision == 2 and store.read_table(spark, root, "parking").count() == 5
    with pytest.raises(DataQualityError):
        store.commit(spark, root, first, second)


def test_of_two_interleaved_writers_one_commits(spark, tmp_path):
    root, rows = str(tmp_path), readings(spark, 1, 8)
    start = store.load_state(spark, root)
    one = store.merge_immutable(spark, root, "parking", rows.where("id <= 4"), start)
    two = store.merge_immutable(spark, root, "parking", rows.where("id > 4"), start)
    after = [start.with_batch("parking", name, span) for name, span, _ in (one, two)]
    # Both looked at the store before either wrote.
    assert store.load_state(spark, root) == start
    first = store.commit(spark, root, start, after[0])
    with pytest.raises(store.StoreChanged):
        store.commit(spark, root, start, after[1])
    assert store.load_state(spark, root) == first and store.read_table(spark, root, "parking").count() == 4
    assert store.append_rows(spark, root, "parking", rows) == 4
    assert store.load_state(spark, root).rows["parking"] == 8 and store.load_state(spark, root).version == 2
    assert not fs.create_json(spark, f"{root}/log/state-{2:012d}.json", {}) and not list(tmp_path.glob("log/*.tmp"))


def test_compaction_keeps_rows_and_deltas_open_what_they_overlap(spark, tmp_path):
    root = str(tmp_path)
    for low in (1, 11, 21, 31):
        store.append_rows(spark, root, "parking", readings(spark, low, low + 9))
    before = store.load_state(spark, root)
    rows = sorted(store.read_table(spark, root, "parking").collect())
    assert [before.ranges[n] for n in before.batches["parking"]] == [[1, 10, 10], [11, 20, 10], [21, 30, 10], [31, 40, 10]]
    assert before.overlapping("parking", 19, 22) == before.batches["parking"][1:3]
    opened = store.read_batches(spark, root, "parking", before.overlapping("parking", 35, 99)).inputFiles()
    assert opened and all(before.batches["parking"][3] in f for f in opened)
    assert store.compaction_groups(before, "parking", 5, 100) == []
    assert store.compact(spark, root, "parking", small=15, most=20) == 4
    after = store.load_state(spark, root)
    assert sorted(after.ranges[n] for n in after.batches["parking"]) == [[1, 20, 20], [21, 40, 20]]
    assert (after.rows, after.cursors, after.revision) == (before.rows, before.cursors, before.revision)
    assert sorted(store.read_table(spark, root, "parking").collect()) == rows
    assert sorted(store.read_table(spark, root, "parking", before).collect()) == rows  # an older dataset still finds its batches
    assert store.append_rows(spark, root, "parking", readings(spark, 15, 44)) == 4
    assert store.compact(spark, root, "parking", small=1) == 0


def test_merge_report(spark):
    held, delta = readings(spark, 1, 6), readings(spark, 4, 9)
    got = store.merge_report(delta, held, ["id"], "id", 3, 9).first().asDict()
    assert got == {"rows": 6, "least": 4, "largest": 9, "new_rows": 3, "known_rows": 3, "changed_rows": 0, "repeated_keys": 0,
                   "outside_rows": 0, "accepted": True}
    broken = delta.withColumn("occupied_spaces", F.when(F.col("id") == 5, 99).otherwise(F.col("occupied_spaces"))).union(delta.where("id = 9"))
    got = store.merge_report(broken, held, ["id"], "id", 4, 8).first()
    assert (got.rows, got.changed_rows, got.repeated_keys, got.outside_rows, got.accepted) == (7, 1, 1, 2, False)
    none = store.merge_report(delta.where("false"), held, ["id"], "id").first()
    assert (none.rows, none.least, none.new_rows, none.accepted) == (0, None, 0, True)


def test_export_is_readable_like_the_dataset(spark, tmp_path):
    root = str(tmp_path)
    delta = {"parking": readings(spark, 1, 5), "passengers": forecasts(spark, 1)}
    store.sync(spark, root, delta, manifest(store.StoreState(), 5, 1, {"parking": 5, "passengers": 96}), NOW)
    dataset = store.assemble(spark, root, NOW)
    store.export(spark, dataset, f"{root}/exported")
    for table in store.EXPORT_ORDER:
        assert sorted(store.read_dataset(spark, f"{root}/exported", table).collect()) == sorted(store.read_dataset(spark, dataset, table).collect())


def test_immutable_rows(spark):
    held, delta = readings(spark, 1, 4), readings(spark, 3, 6)
    keys = ["id"]
    assert store.delta_violations(delta, held, keys, "id", 2, 6).count() == 0
    assert sorted(r.id for r in store.new_rows(delta, held, keys).collect()) == [5, 6]
    changed = delta.withColumn("total_spaces", F.when(F.col("id") == 3, F.lit(None)).otherwise(F.col("total_spaces")).cast("int"))
    found = store.delta_violations(changed.union(delta.where("id = 6")), held, keys, "id", 3, 5, allow_replay=False)
    got = {r.rule: r.n for r in found.collect()}
    assert got == {"stored row changed": 1, "row outside the cursor range": 3, "row was stored before": 2, "repeated key in the delta": 2}
    with pytest.raises(DataQualityError):
        enforce(found)


def test_insert_ignore_keeps_the_first(spark):
    start = at("2026-10-08 00:00:00")
    held = parking(spark, [(start, 1)])
    delta = parking(spark, [(start, 2), (start + timedelta(minutes=1), 4, 100, start + timedelta(minutes=9)), (start + timedelta(minutes=1), 3)])
    got = store.insert_ignore(delta, held, ["source", "lot_name", "observed_at"], ["collected_at", "id"]).collect()
    assert [r.occupied_spaces for r in got] == [3]


def test_vintages_and_snapshots_to_store(spark):
    day = date(2026, 10, 9)
    held = batch(spark, day, 1)
    recheck = [batch(spark, day, n, fetched=at(f"2026-10-08 1{n}:00:00"), **c).withColumn("phase", F.lit("recheck"))
               for n, c in ((2, {}), (3, {"T1_arrival_3": 9}))]
    got = store.vintages_to_store(recheck[0].union(recheck[1]), held).select("batch_id", "changed_count").distinct().collect()
    assert [tuple(r) for r in got] == [(3, 1)]
    kind = "id bigint, source string, kind string, fetched_at timestamp_ntz, scope string, records string"
    seen = at("2026-10-08 00:00:00")
    stored = spark.createDataFrame([(1, "s", "holidays", seen, '{"year": 2026, "month": 1}', '[{"a": 1, "b": 2}]'),
                                    (2, "s", "flights", seen, "{}", "[]")], kind)
    incoming = spark.createDataFrame([(3, "s", "holidays", seen, '{"month":1,"year":2026}', '[{"b":2,"a":1}]'),
                                      (4, "s", "flights", seen, "{}", "[]"),
                                      (5, "s", "holidays", seen, '{"year":2026,"month":2}', "[]"),
                                      (6, "s", "holidays", seen, '{"year":2026,"month":1}', "[]")], kind)
    assert sorted(r.id for r in store.snapshots_to_store(incoming, stored).collect()) == [4, 5, 6]


def test_freshness():
    def state(seconds):
        return store.StoreState(last_synced_at=(NOW - timedelta(seconds=seconds)).isoformat())

    assert store.needs_refresh(store.StoreState(), NOW)
    assert not store.needs_refresh(state(3599), NOW)
    assert store.needs_refresh(state(3600), NOW) and store.needs_refresh(state(-1), NOW)


def test_pointer_must_stay_inside(spark, tmp_path):
    fs.write_json(spark, f"{tmp_path}/latest.json", {"dataset_dir": "../outside"})
    with pytest.raises(DataQualityError):
        scan.resolve_latest(spark, str(tmp_path))


def test_runs_do_not_change_and_evaluations_do(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([("2026-10-08", 1), ("2026-10-09", 2)], "issue_date string, v int")
    sinks.write_run(spark, root, "r1", {"t": frame}, {"manifest": {"a": 1}})
    assert sinks.issued_runs(spark, root) == {}
    sinks.issue(spark, root, "2026-10-08", "r1")
    assert sinks.issued_runs(spark, root) == {"2026-10-08": "r1"} and sinks.issued_run(spark, root, "2026-10-09") is None
    with pytest.raises(Exception):
        sinks.write_run(spark, root, "r1", {"t": frame}, {"manifest": {"a": 1}})
    sinks.write_evaluations(f"{root}/e", frame)
    sinks.write_evaluations(f"{root}/e", frame.where("v = 2").withColumn("v", F.lit(5)))
    assert sorted(r.v for r in spark.read.parquet(f"{root}/e").collect()) == [1, 5]
