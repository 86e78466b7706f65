"""Registered queries against their DuckDB SQL on the small driver tables.

The session zone of the tests is not UTC, so zone-dependent code would show.
"""

import math
from pathlib import Path

import pytest

from parity.oracles import ORACLES
from parity.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
CHECKED = [
    "normalize_parking", "normalize_passenger", "page_violations", "dedup_first", "duplicate_and_clock_counts",
    "gap_minutes", "quality_per_lot", "lot_columns", "cyclic_time_hourly", "hourly_truth", "same_hour_history",
    "asof_lag", "asof_forecast", "nearest_label", "latest_anchor", "batch_complete", "key_set_equal",
    "changed_count", "revision_filter", "pivot_direction", "latest_snapshot", "codeshare_collapse",
    "flight_day_features", "holiday_flags", "temporal_split", "delta_violations", "stream_hourly_truth",
    "stream_dedup", "stream_ingest", "stream_late_rows", "merge_checked", "truth_incremental", "latest_anchor_state", "history_from_summary",
    "flight_problems",
]


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        found.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return found


def comparable(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)

    def value(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v

    return sorted(repr([value(row[i]) for i in order]) for row in rows)


@pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, str(DATA))
    cursor = connection.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert comparable(frame.collect(), frame.columns) == comparable(cursor.fetchall(), names)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")
def test_day_split_builds_its_rows_once(spark):
    """Rows, days and bounds are read from written rows, not from the readings."""
    plan = QUERIES["day_split"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "occupied_spaces" not in plan and "event_id" not in plan


@pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")
def test_preprocess_builds_its_rows_once(spark):
    """The result is read from written rows; the lookups of the features ran before the fit."""
    plan = QUERIES["preprocess"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
