"""The kept summary of readings against the operators that scan readings."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import LOT, batch, no_context, parking
from tidelot.functions.time import DEFAULT_CUTOFF, cutoff_instant, instant
from tidelot.operators import summaries, truth
from tidelot.operators.quality import clean_parking
from tidelot.plans import nextday
from tidelot.sources import store, summary

START = datetime(2026, 10, 1)
ISSUE = date(2026, 10, 6)


def noisy(spark, seed=1, count=900):
    """Readings of two lots with copies, closed rows, clock errors and late collection."""
    dice = random.Random(seed)
    rows = []
    for i in range(count):
        seen = START + timedelta(minutes=10 * i + dice.randrange(3))
        delay = dice.choice([0.5, 0.5, 0.5, 200, 1500, -1])
        rows.append((seen, dice.randrange(130), dice.choice([100, 100, 100, 0]), seen + timedelta(minutes=delay)))
        if dice.random() < 0.15:  # a copy, at times collected before the first
            rows.append((seen, dice.randrange(130), 100, seen + timedelta(minutes=delay + dice.choice([-0.25, 30, 2000]))))
    first = parking(spark, rows)
    return first.unionByName(parking(spark, rows[::2], lot="T2 단기주차장").withColumn("id", F.col("id") + 100_000))


def plain(df):
    return sorted(repr(x) for x in near_rows(df))


def near_rows(df):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()]


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert plain(a) == plain(b)


def test_truth_history_and_anchors_follow_from_the_summary(spark):
    clean = clean_parking(noisy(spark))
    known = summaries.reading_summary(clean)
    same(summaries.summary_truth(known), truth.hourly_truth(clean))
    same(summaries.summary_history(known), truth.same_hour_history(clean, DEFAULT_CUTOFF))
    cutoff = instant(cutoff_instant(ISSUE))
    seen = truth.hourly_truth(clean, cutoff)
    same(summaries.summary_truth(known, F.lit(ISSUE)), seen)
    issues = spark.createDataFrame([(date(2026, 10, d),) for d in range(1, 10)], "issue_date date")
    anchors = summaries.summary_anchors(known)
    want = nextday.latest_anchors(clean, issues)
    same(nextday.carried_anchors(anchors, issues), want)
    later = issues.where(F.col("issue_date") > F.lit(ISSUE))
    state = summaries.anchor_state(anchors, F.lit(ISSUE)).unionByName(anchors.where(F.col("known_from") > F.lit(ISSUE)))
    same(nextday.carried_anchors(state, later), want.where(F.col("issue_date") > F.lit(ISSUE)))


@pytest.mark.parametrize("seed", [2, 3])
def test_merges_equal_one_pass(spark, seed):
    """In whatever order readings land, copies collected earlier than what is stored included."""
    raw = noisy(spark, seed, 300)
    part = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(3))
    parts = [raw.where(part == i) for i in range(3)]
    known, stored = summaries.reading_summary(clean_parking(parts[0])), parts[0]
    for delta in parts[1:]:
        known, stored = summaries.merge_summary(known, stored, delta), stored.unionByName(delta)
    same(known, summaries.reading_summary(clean_parking(raw)))
    empty = raw.where("false")
    same(summaries.merge_summary(known, raw, empty), known)
    assert summaries.reading_summary(empty).count() == 0


def test_the_store_keeps_its_summary(spark, tmp_path):
    root, raw = str(tmp_path), noisy(spark, 4, 600)
    edges = [START + timedelta(days=d) for d in (0, 2, 3, 9)]
    seen = F.col("collected_at")
    written = []
    for low, high in zip(edges[:-1], edges[1:]):
        store.append_rows(spark, root, "parking", raw.where((seen >= instant(low)) & (seen < instant(high))))
        written.append(summary.refresh_summary(spark, root))
        assert summary.refresh_summary(spark, root) == 0
    held = store.read_table(spark, root, "parking")
    state = store.load_state(spark, root)
    same(summary.read_summary(spark, root, state), summaries.reading_summary(clean_parking(held)))
    # The second refresh wrote the days of its readings only.
    assert written[1] < len(state.summary_days) and set(state.summarised) == set(state.batches["parking"])
    day = date(2026, 10, 3)
    files = summary.read_summary(spark, root, state, day, day).inputFiles()
    assert files and all(f"target_day={day}" in f for f in files)
    assert store.compact(spark, root, "parking") == 3 and summary.refresh_summary(spark, root) == 0
    dataset = store.assemble(spark, root, datetime(2026, 10, 9))
    same(summary.dataset_summary(spark, dataset, DEFAULT_CUTOFF), summaries.reading_summary(clean_parking(held)))
    assert summary.dataset_summary(spark, dataset, "09:00") is None
    store.append_rows(spark, root, "parking", raw.limit(1).withColumn("id", F.lit(999_999).cast("long")))
    late = store.assemble(spark, root, datetime(2026, 10, 10))
    assert summary.dataset_summary(spark, late, DEFAULT_CUTOFF) is None
    assert summary.refresh_summary(spark, root, "09:00") > 0  # another cutoff begins anew


def test_an_issue_from_the_summary_scans_no_reading(spark, tmp_path):
    path = str(tmp_path / "readings")
    noisy(spark, 5).where(F.col("lot_name") == LOT).write.parquet(path)
    clean = clean_parking(spark.read.parquet(path))
    known_at = str(tmp_path / "summary")
    summaries.reading_summary(clean).write.parquet(known_at)
    known = spark.read.parquet(known_at)
    issues = spark.createDataFrame([(ISSUE,)], "issue_date date")
    forecasts = batch(spark, ISSUE + timedelta(days=1)).drop("target_date")
    args = (forecasts, no_context(spark), issues)
    fast = nextday.build_days(clean, *args, summary=known)
    same(fast, nextday.build_days(clean, *args))
    same(nextday.skipped_days(clean, *args, summary=known), nextday.skipped_days(clean, *args))
    files = fast.inputFiles()
    assert any("/summary/" in f for f in files) and not any("/readings/" in f for f in files)
