"""The domain tables, derived from whole driver tables.

The same SQL text runs on Spark and on DuckDB; only the timestamp literal and
the explode syntax differ.  Every view scans its source table completely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Readings: events are observations of four lots, with copies, clock errors,
# late rows, closed rows and over-capacity rows mixed in. Ids of readings are even, those of
# copies odd, so that no copy takes the id of a reading.
PARK_RAW = """
WITH base AS (
 SELECT event_id, 'test' AS source,
  CASE user_id % 4 WHEN 0 THEN 'T1 단기주차장' WHEN 1 THEN 'T1 장기 P1 주차장'
       WHEN 2 THEN 'T2 장기 주차장' ELSE 'T2 예약 주차장' END AS lot_name,
  ts AS observed_at,
  CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL '1' MINUTE
       WHEN event_id % 31 = 0 THEN ts + INTERVAL '3' HOUR
       ELSE ts + INTERVAL '30' SECOND END AS collected_at,
  CAST(floor(value) AS INT) AS occupied_spaces,
  CAST(CASE WHEN event_id % 50 = 7 THEN 0 ELSE 100 + 20 * (user_id % 3) END AS INT) AS total_spaces
 FROM events)
SELECT 2 * event_id AS id, source, lot_name, observed_at, collected_at, occupied_spaces, total_spaces FROM base
UNION ALL
SELECT 2 * event_id + 1, source, lot_name, observed_at, collected_at + INTERVAL '1' MINUTE,
 occupied_spaces + 1, total_spaces FROM base WHERE event_id % 40 = 3
"""

PARKING = """
SELECT id, source, lot_name, observed_at, collected_at, occupied_spaces, total_spaces FROM (
 SELECT *, row_number() OVER (PARTITION BY lot_name, observed_at ORDER BY collected_at, id) AS rn FROM park_raw) z
WHERE rn = 1 AND observed_at <= collected_at
"""

# Forecast totals per hour, terminal and direction: sums over all line items.
CELLS = """
SELECT CAST((l_orderkey * 7 + l_linenumber) % 744 AS INT) AS n, CAST(l_partkey % 2 AS INT) AS t,
 CAST(l_suppkey % 2 AS INT) AS dir, CAST(sum(l_quantity) AS BIGINT) AS total
FROM lineitem GROUP BY 1, 2, 3
"""

# Three vintages of each day: the evening baseline, a night recheck (equal on odd
# days) and a same-day one.  Some baselines lack a key.
VINTAGES = """
SELECT dd * 3 + v + 1 AS batch_id, 'test' AS source,
 CASE v WHEN 0 THEN TIMESTAMP '2023-12-31 08:10:10' WHEN 1 THEN TIMESTAMP '2023-12-31 14:05:00'
        ELSE TIMESTAMP '2024-01-01 02:05:00' END + dd * INTERVAL '1' DAY AS fetched_at,
 CASE WHEN dd % 5 = 4 THEN NULL ELSE CAST(TIMESTAMP '2024-01-01 00:00:00' + dd * INTERVAL '1' DAY AS DATE) END AS target_date,
 CASE WHEN v < 2 THEN 1 ELSE 0 END AS day_offset,
 CASE WHEN v = 0 THEN 'baseline' ELSE 'recheck' END AS phase,
 TIMESTAMP '2023-12-31 15:00:00' + n * INTERVAL '1' HOUR AS target_hour,
 CASE t WHEN 0 THEN 'T1' ELSE 'T2' END AS terminal,
 CASE dir WHEN 0 THEN 'arrival' ELSE 'departure' END AS direction,
 total + CASE WHEN dd % 2 = 0 THEN v * (n % 2) ELSE 0 END AS expected_passengers
FROM (SELECT *, CAST(floor(CAST(n AS DOUBLE) / 24) AS INT) AS dd FROM (SELECT *, {explode_v} AS v FROM cells) c) x
WHERE NOT (dd % 7 = 3 AND v = 0 AND n % 24 = 5 AND t = 0 AND dir = 0)
"""

# Flight records: every line item is a record of one of 62 day-and-direction snapshots.
FLIGHTS = """
SELECT CAST(dd * 2 + dir + 1 AS BIGINT) AS snapshot_id,
 l_linenumber AS pos,
 CASE dir WHEN 0 THEN 'arrival' ELSE 'departure' END AS direction,
 CAST(TIMESTAMP '2024-01-01 00:00:00' + dd * INTERVAL '1' DAY AS DATE) AS target_date,
 concat('F', CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(20))) AS flight_id,
 CASE WHEN l_linenumber > 1 THEN concat('F', CAST(l_orderkey AS VARCHAR(20)), '-1') ELSE '' END AS master_flight_id,
 CASE WHEN l_linenumber > 1 THEN 'Slave' ELSE 'Master' END AS codeshare,
 CASE l_orderkey % 3 WHEN 0 THEN 'P01' WHEN 1 THEN 'P02' ELSE 'P03' END AS terminal_id,
 concat('202401', substr(CAST(101 + dd AS VARCHAR(3)), 2, 2),
        substr(CAST(100 + CAST(floor(CAST(mm AS DOUBLE) / 60) AS INT) AS VARCHAR(3)), 2, 2),
        substr(CAST(100 + mm % 60 AS VARCHAR(3)), 2, 2)) AS scheduled_text,
 CASE WHEN l_orderkey % 20 = 0 THEN '결항' WHEN l_orderkey % 33 = 0 THEN 'Cancelled' ELSE '' END AS remark
FROM (SELECT l_orderkey, l_linenumber, CAST(l_orderkey % 31 AS INT) AS dd,
       CAST(floor(CAST(l_orderkey AS DOUBLE) / 31) AS INT) % 2 AS dir, CAST((l_orderkey * 37) % 1440 AS INT) AS mm FROM lineitem) x
"""

# Holiday records: every order is a record of one of four calendar snapshots
# (two months, two revisions); the second revision adds a holiday.
HOLIDAYS = """
SELECT CAST((CASE WHEN dd < 31 THEN 1 ELSE 2 END) * 10 + rev + 5000 AS BIGINT) AS snapshot_id,
 CAST(TIMESTAMP '2024-01-01 00:00:00' + dd * INTERVAL '1' DAY AS DATE) AS locdate,
 CASE WHEN dd % 9 = 0 OR (rev = 1 AND dd = 24) THEN 'Y' ELSE 'N' END AS is_holiday,
 CAST(o_orderkey AS VARCHAR(20)) AS seq, o_orderpriority AS date_name
FROM (SELECT o_orderkey, o_orderpriority, CAST(o_orderkey % 60 AS INT) AS dd, CAST(floor(CAST(o_orderkey AS DOUBLE) / 60) AS INT) % 2 AS rev
      FROM orders) x
"""

# Snapshot headers, one per snapshot that occurs in the records; some are too old
# or missing, and a copy of each flight snapshot arrives after the cutoff.
HEADERS = """
WITH f AS (SELECT snapshot_id, direction, target_date FROM flights GROUP BY 1, 2, 3),
h AS (SELECT snapshot_id, CAST(floor(CAST(snapshot_id - 5000 AS DOUBLE) / 10) AS INT) AS m FROM holidays GROUP BY 1)
SELECT snapshot_id AS id, 'test' AS source, 'flights' AS kind,
 CAST(target_date AS TIMESTAMP) - INTERVAL '1' DAY + INTERVAL '490' MINUTE
  - CASE WHEN snapshot_id % 11 = 0 THEN 1 ELSE 0 END * INTERVAL '1' DAY AS fetched_at,
 target_date, direction, 'scheduled' AS time_basis, CAST(NULL AS INT) AS year, CAST(NULL AS INT) AS month
FROM f WHERE snapshot_id % 13 <> 0
UNION ALL
SELECT snapshot_id + 1000, 'test', 'flights', CAST(target_date AS TIMESTAMP) - INTERVAL '1' DAY + INTERVAL '496' MINUTE,
 target_date, direction, 'scheduled', NULL, NULL FROM f
UNION ALL
SELECT snapshot_id, 'test', 'holidays',
 CASE WHEN snapshot_id % 10 = 0 THEN TIMESTAMP '2023-12-20 00:00:00' ELSE TIMESTAMP '2024-01-15 03:00:00' END
  + (m - 1) * INTERVAL '12' DAY, NULL, NULL, NULL, 2024, m FROM h
"""

VIEWS = {
    "park_raw": PARK_RAW, "parking": PARKING, "cells": CELLS, "vintages": VINTAGES,
    "flights": FLIGHTS, "holidays": HOLIDAYS, "headers": HEADERS,
}
SOURCES = {
    "park_raw": ["events"], "parking": ["park_raw"], "cells": ["lineitem"], "vintages": ["cells"],
    "flights": ["lineitem"], "holidays": ["orders"], "headers": ["flights", "holidays"],
}


def _closure(names: tuple[str, ...]) -> list[str]:
    wanted: list[str] = []
    for name in names:
        for need in [*_closure(tuple(s for s in SOURCES[name] if s in VIEWS)), name]:
            if need not in wanted:
                wanted.append(need)
    return wanted


def duckdb_with(*names: str) -> str:
    """``WITH`` list that defines the views in DuckDB."""
    parts = [f"{n} AS ({VIEWS[n].format(explode_v='unnest([0, 1, 2])')})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_text(name: str) -> str:
    """The view in Spark's dialect, its sources as ``{name}`` placeholders."""
    text = VIEWS[name].replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
    text = text.format(explode_v="explode(array(0, 1, 2))")
    for source in SOURCES[name]:
        text = text.replace(f"FROM {source}", "FROM {" + source + "}")
    return text


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame; sources are passed as arguments, not registered."""
    inputs = {s: view(spark, sf_dir, s) if s in VIEWS else table(spark, sf_dir, s) for s in SOURCES[name]}
    return spark.sql(spark_text(name), **inputs)
