"""Streams agree with the batch operators."""

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import at
from frames import every_ten, parking
from parity import queries
from tidelot import schemas
from tidelot.operators.truth import hourly_truth
from tidelot.session import scratch_path, shared_dir
from tidelot.sources import store
from tidelot.streaming import flows

START = at("2026-10-08 00:00:00")


def landed(spark, frame):
    path = scratch_path(spark, "landed")
    frame.write.parquet(path)
    return path


def drained(spark, stream):
    out = scratch_path(spark, "out")
    flows.drain_to_parquet(stream, out, scratch_path(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def test_hourly_truth_stream_equals_batch(spark):
    rows = parking(spark, every_ten(START, 60, lambda i: 50 + i) + [(START + timedelta(hours=2, minutes=3), 0, 0)])
    stream = flows.read_files(spark, landed(spark, rows), schemas.PARKING)
    got = drained(spark, flows.stream_hourly_truth(stream, "1 hour")).collect()
    want = {r.target_hour: r for r in hourly_truth(rows).collect()}
    # The last reading is at 09:50, so hours that end by 08:50 are final.
    assert sorted(r.target_hour for r in got) == [START + timedelta(hours=h) for h in range(8)]
    for r in got:  # a mean may differ in its last digit with the order of summation
        assert (r.lot_name, r.observation_slots, r.label_available_at) == (
            want[r.target_hour].lot_name, want[r.target_hour].observation_slots, want[r.target_hour].label_available_at)
        assert [r.actual_ratio, r.actual_max_ratio, r.actual_min_ratio] == pytest.approx(
            [want[r.target_hour][c] for c in ("actual_ratio", "actual_max_ratio", "actual_min_ratio")])


def test_dedup_stream(spark):
    rows = parking(spark, every_ten(START, 20, lambda i: i))
    later = rows.selectExpr("id + 100 as id", "source", "lot_name", "observed_at", "collected_at + interval 1 minute as collected_at",
                            "occupied_spaces + 1 as occupied_spaces", "total_spaces")
    stream = flows.read_files(spark, landed(spark, later.union(rows).union(rows)), schemas.PARKING)
    got = drained(spark, flows.stream_dedup(stream, "20 minutes")).collect()
    # The last reading is at 03:10; those up to 02:50 can have no earlier copy any more.
    assert sorted(r.id for r in got) == list(range(1, 19))


def test_hourly_truth_stream_removes_copies(spark):
    rows = parking(spark, every_ten(START, 30, lambda i: 50))
    copies = rows.selectExpr("id + 100 as id", "source", "lot_name", "observed_at", "collected_at + interval 1 minute as collected_at",
                             "cast(99 as int) as occupied_spaces", "total_spaces")
    stream = flows.read_files(spark, landed(spark, copies.union(rows)), schemas.PARKING)
    got = drained(spark, flows.stream_hourly_truth(stream, "10 minutes")).collect()
    assert got and all(r.actual_ratio == 0.5 for r in got)


def test_ingest_stream_is_idempotent(spark, tmp_path):
    rows = parking(spark, every_ten(START, 12, lambda i: i))
    path, root = landed(spark, rows), str(tmp_path)
    for _ in range(2):
        stream = flows.read_files(spark, path, schemas.PARKING)
        flows.drain_batches(stream, flows.ingest_into(spark, root, "parking"), scratch_path(spark, "checkpoint"))
    state = store.load_state(spark, root)
    assert (state.rows["parking"], state.cursors["parking_id"], state.revision) == (12, 12, 1)
    assert store.read_table(spark, root, "parking").count() == 12
    # Two checkpoints are two streams, each with its first epoch.
    assert list(state.epochs.values()) == [0, 0] and state.version == 2


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_ingest_goes_on_from_its_checkpoint(spark, tmp_path):
    root, checkpoint = tmp_path / "store", scratch_path(spark, "checkpoint")
    first = parking(spark, every_ten(START, 12, lambda i: i))
    path = landed(spark, first)
    for more in (None, parking(spark, every_ten(START, 18, lambda i: i)).where("id > 12")):
        if more is not None:
            more.write.mode("append").parquet(path)
        stream = flows.read_files(spark, path, schemas.PARKING)
        flows.drain_batches(stream, flows.ingest_into(spark, str(root), "parking"), checkpoint)
    state = store.load_state(spark, str(root))
    assert list(state.epochs.values()) == [1] and state.rows["parking"] == 18


def test_a_replayed_epoch_stores_nothing_and_leaves_no_folder(spark, tmp_path):
    root = str(tmp_path / "store")
    before = folders(Path(shared_dir(spark)))
    rows = parking(spark, every_ten(START, 6, lambda i: i))
    merge = flows.ingest_into(spark, root, "parking", "readings")
    merge(rows.where("id <= 3"), 0)
    merge(rows.where("id > 3"), 1)
    state = store.load_state(spark, root)
    # Whatever an epoch brings the second time, it is the same epoch.
    merge(rows.where("id > 3").selectExpr("id + 50 as id", *[c for c in rows.columns if c != "id"]), 1)
    merge(rows.where("id <= 3"), 0)
    assert store.load_state(spark, root) == state and state.epochs == {"readings": 1} and state.rows["parking"] == 6
    assert folders(tmp_path / "store" / "parking") == sorted(state.batches["parking"])
    merge(rows.where("id = 2"), 2)  # a new epoch with known rows: the epoch is noted, nothing is stored
    assert store.load_state(spark, root).epochs == {"readings": 2} and len(folders(tmp_path / "store" / "parking")) == 2
    assert folders(Path(shared_dir(spark))) == before


def test_an_epoch_is_merged_again_where_another_writer_was_faster(spark, tmp_path, monkeypatch):
    root, rows = str(tmp_path), parking(spark, every_ten(START, 6, lambda i: i))
    real, calls = store.merge_immutable, []

    def interrupted(*args, **kwargs):
        calls.append(1)
        out = real(*args, **kwargs)
        if len(calls) == 1:  # the other writer commits between this one's merge and its commit
            store.append_rows(spark, root, "parking", rows.where("id <= 2"))
        return out

    monkeypatch.setattr(store, "merge_immutable", interrupted)
    flows.ingest_into(spark, root, "parking", "readings")(rows.where("id > 1"), 0)
    state = store.load_state(spark, root)
    assert state.rows["parking"] == 6 and len(calls) == 3 and state.epochs == {"readings": 0}
    assert folders(tmp_path / "parking") == sorted(state.batches["parking"])


def test_late_rows_are_kept_counted_and_repaired(spark, tmp_path):
    out, checkpoint = str(tmp_path / "late"), scratch_path(spark, "checkpoint")
    rows = parking(spark, every_ten(START, 60, lambda i: 50 + i % 40))
    watch = flows.watch_late(spark, out, "1 hour")
    path = scratch_path(spark, "landed")
    # Readings 10 to 12 come behind the watermark, which stands an hour before the 30th; reading 28 does not.
    for some in ("id <= 30 and id not in (10, 11, 12, 28)", "id in (10, 11, 28) or id > 30", "id = 12"):
        rows.where(some).write.mode("append").parquet(path)
        flows.drain_batches(flows.read_files(spark, path, schemas.PARKING), watch, checkpoint)
    late = flows.late_rows(spark, out, rows.schema)
    assert sorted((r.id, r.epoch) for r in late.collect()) == [(10, 1), (11, 1), (12, 2)] and flows.late_count(spark, out) == 3
    want = {r.target_hour: r for r in hourly_truth(rows).collect()}
    got = flows.repaired_truth(late, rows).collect()
    assert [(r.target_hour, r.late_rows, r.last_epoch) for r in got] == [(START + timedelta(hours=1), 3, 2)]
    assert got[0].actual_ratio == pytest.approx(want[got[0].target_hour].actual_ratio) and got[0].observation_slots == 6
    # An epoch that runs again writes what it wrote before.
    watch(rows.where("id = 12"), 2)
    assert flows.late_count(spark, out) == 3 and flows.late_rows(spark, out, rows.schema).count() == 3


def test_no_late_rows_yet(spark, tmp_path):
    rows = parking(spark, every_ten(START, 3, lambda i: i))
    late = flows.late_rows(spark, str(tmp_path), rows.schema)
    assert late.count() == 0 and flows.late_count(spark, str(tmp_path)) == 0 and flows.repaired_truth(late, rows).count() == 0


def test_a_stream_that_loses_an_hour_fails_the_comparison(spark, monkeypatch):
    """The registered query fills only what the watermark has not passed."""
    whole = stream_truth_rows(spark)
    real = queries.drained

    def losing(spark, stream, name):
        rows = real(spark, stream, name)
        return rows.where(F.col("target_hour") != rows.agg(F.min("target_hour")).scalar())

    monkeypatch.setattr(queries, "drained", losing)
    assert len(stream_truth_rows(spark)) < len(whole)


def stream_truth_rows(spark):
    return queries.QUERIES["stream_hourly_truth"](spark, "/root/testdata/sf0.001").collect()
