"""DuckDB SQL for the registered queries, written independently of the operators.

The SQL states each result directly: as-of joins, correlated windows over whole
keys and distinct counts, where the library uses buckets, masks and partial
aggregates.
"""

from __future__ import annotations

from parity.views import duckdb_with

ORACLES: dict[str, str] = {}

CUT = "INTERVAL '495' MINUTE"  # 17:15 local is 08:15 UTC
RATIO = "CAST(occupied_spaces AS DOUBLE) / total_spaces"
LOT_TYPE = (
    "CASE WHEN lot_name LIKE '%단기%' THEN 'short' WHEN lot_name LIKE '%장기%' THEN 'long' "
    "WHEN lot_name LIKE '%예약%' THEN 'reservation' ELSE 'unknown' END"
)
TERMINAL = "CASE WHEN left(lot_name, 2) IN ('T1', 'T2') THEN left(lot_name, 2) ELSE 'unknown' END"


def add(name: str, sql: str) -> None:
    ORACLES[name] = sql


def sec(a: str, b: str) -> str:
    """Seconds from ``a`` to ``b``."""
    return f"(epoch_us({b}) - epoch_us({a})) / 1000000.0"


def mins(a: str, b: str) -> str:
    """Minutes from ``a`` to ``b`` in one division."""
    return f"CAST(epoch_us({b}) - epoch_us({a}) AS DOUBLE) / CAST(60000000 AS DOUBLE)"


def metric_sql(a: str, p: str) -> str:
    return f"""CAST(count(*) AS BIGINT) AS rows, round(avg(abs({a} - {p})) * 100, 6) AS mae_percentage_points,
 round(sqrt(avg(({a} - {p}) * ({a} - {p}))) * 100, 6) AS rmse_percentage_points,
 round(coalesce(2.0 * count(*) FILTER ({a} >= 0.9 AND {p} >= 0.9) / nullif(2.0 * count(*) FILTER ({a} >= 0.9 AND {p} >= 0.9)
   + count(*) FILTER (({a} >= 0.9) <> ({p} >= 0.9)), 0), 0.0), 6) AS busy_f1,
 CAST(count(*) FILTER ({a} >= 0.9) AS BIGINT) AS actual_busy_rows, CAST(90.0 AS DOUBLE) AS busy_threshold_pct"""


# --- Landed payloads -------------------------------------------------------

ITEMS = """
SELECT id AS request_id, concat(' ', lot_name, '  ') AS floor, lot_name, total_spaces,
 CASE WHEN id % 53 = 0 THEN 'x' ELSE CAST(occupied_spaces AS VARCHAR) END AS parking,
 CAST(total_spaces AS VARCHAR) AS parkingarea,
 concat(strftime(observed_at + INTERVAL '9' HOUR, '%Y%m%d%H%M%S'), '.',
        lpad(CAST((epoch_us(observed_at) // 1000) % 1000 AS VARCHAR), 3, '0')) AS datetm,
 observed_at, occupied_spaces FROM park_raw
"""
add("parse_parking_payload", f"""{duckdb_with('park_raw')}, items AS ({ITEMS})
SELECT request_id // 250 AS request_id, request_id % 250 // 100 + 1 AS page, floor, parking, parkingarea, datetm FROM items""")
add("page_violations", f"""{duckdb_with('park_raw')}, items AS ({ITEMS}),
r AS (SELECT DISTINCT request_id // 250 AS q FROM items)
SELECT 'request failed' AS rule, CAST(count(*) AS BIGINT) AS n FROM r WHERE q % 11 = 5 HAVING count(*) > 0
UNION ALL
SELECT 'items differ from the total count', count(*) FROM r WHERE q % 7 = 3 HAVING count(*) > 0""")
add("normalize_parking", f"""{duckdb_with('park_raw')}, items AS ({ITEMS})
SELECT request_id, lot_name, CASE WHEN parking = 'x' THEN NULL ELSE occupied_spaces END AS occupied_spaces, total_spaces,
 date_trunc('millisecond', observed_at) AS observed_at, parking <> 'x' AS is_valid FROM items""")
PAX_ITEMS = """
SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS TIMESTAMP) AS d FROM orders
"""
add("normalize_passenger", f"""WITH i AS ({PAX_ITEMS}),
h AS (SELECT k, c, k % 41 <> 0 AS one_hour, d + (k % 24) * INTERVAL '1' HOUR - INTERVAL '9' HOUR AS hr FROM i WHERE k % 25 <> 24),
t AS (SELECT k, one_hour, hr, 'T1' AS terminal, 'arrival' AS direction, k % 977 AS v FROM h
 UNION ALL SELECT k, one_hour, hr, 'T1', 'departure', k % 613 FROM h
 UNION ALL SELECT k, one_hour, hr, 'T2', 'arrival', CASE WHEN k % 37 = 0 THEN NULL ELSE c % 500 END FROM h
 UNION ALL SELECT k, one_hour, hr, 'T2', 'departure', CASE WHEN k % 43 = 0 THEN NULL ELSE c % 300 END FROM h)
SELECT k AS request_id, CASE WHEN one_hour THEN hr END AS target_hour, terminal, direction,
 CAST(v AS INT) AS expected_passengers, one_hour AND v IS NOT NULL AS is_valid FROM t""")
add("is_summary_row", "SELECT o_orderkey % 25 = 24 AS is_summary, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")

# --- Readings --------------------------------------------------------------

P = duckdb_with("parking")
RAW = duckdb_with("park_raw")
DEDUP = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lot_name, observed_at ORDER BY collected_at, id) AS rn FROM {src}) z WHERE rn = 1"
PARK_COLUMNS = "id, source, lot_name, observed_at, collected_at, occupied_spaces, total_spaces"
add("dedup_first", f"{RAW} SELECT {PARK_COLUMNS} FROM ({DEDUP.format(src='park_raw')}) q")
add("filter_clock_order", f"{RAW} SELECT * FROM park_raw WHERE observed_at <= collected_at")
add("filter_operating", f"{P} SELECT * FROM parking WHERE total_spaces > 0")
add("visible_as_of", f"""{P} SELECT * FROM parking
WHERE collected_at <= TIMESTAMP '2024-01-20 08:15:00' AND observed_at <= TIMESTAMP '2024-01-20 08:15:00'""")
add("duplicate_and_clock_counts", f"""{RAW}, d AS ({DEDUP.format(src='park_raw')})
SELECT CAST((SELECT count(*) FROM park_raw) - (SELECT count(*) FROM d) AS BIGINT) AS duplicate_rows_removed,
 CAST((SELECT count(*) FROM d WHERE observed_at > collected_at) AS BIGINT) AS invalid_clock_rows_excluded""")
GAPS = f"""SELECT *, {mins('lag(observed_at) OVER w', 'observed_at')} AS gap_minutes FROM parking
 WINDOW w AS (PARTITION BY lot_name ORDER BY observed_at)"""
add("gap_minutes", f"{P} SELECT id, lot_name, observed_at, gap_minutes FROM ({GAPS}) g")
add("quality_per_lot", f"""{P} SELECT lot_name, CAST(count(*) AS BIGINT) AS rows, min(observed_at) AS first_observed_at,
 max(observed_at) AS last_observed_at, CAST(count(*) FILTER (gap_minutes > 20) AS BIGINT) AS gaps_over_20_minutes,
 max(gap_minutes) AS max_gap_minutes, CAST(count(DISTINCT total_spaces) AS BIGINT) AS capacity_versions,
 CAST(count(*) FILTER (total_spaces = 0) AS BIGINT) AS inactive_rows,
 CAST(count(*) FILTER (total_spaces > 0 AND occupied_spaces > total_spaces) AS BIGINT) AS over_capacity_rows
FROM ({GAPS}) g GROUP BY lot_name""")
add("quality_global", f"""{P} SELECT CAST(count(*) AS BIGINT) AS parking_rows, CAST(count(DISTINCT lot_name) AS BIGINT) AS lots,
 min(observed_at) AS first_observed_at, max(observed_at) AS last_observed_at,
 round({sec('min(observed_at)', 'max(observed_at)')} / 86400, 6) AS span_days FROM parking""")
add("violations", f"""{RAW}, b AS (SELECT lpad(CAST(id AS VARCHAR), 12, '0') AS k, id % 61 = 0 AS blank, id % 67 = 0 AS neg FROM park_raw)
SELECT 'missing lot name' AS rule, CAST(count(*) AS BIGINT) AS n, min(k) AS key FROM b WHERE blank HAVING count(*) > 0
UNION ALL SELECT 'bad occupied count', count(*), min(k) FROM b WHERE neg HAVING count(*) > 0""")
OPEN = f"""SELECT *, {RATIO} AS ratio, {TERMINAL} AS terminal, {LOT_TYPE} AS lot_type,
 collected_at AS origin_at, collected_at + INTERVAL '1' HOUR AS requested_target_at FROM parking WHERE total_spaces > 0"""
add("lot_columns", f"""{P} SELECT id, round(ratio, 6) AS current_ratio, terminal, lot_type,
 {mins('observed_at', 'origin_at')} AS observation_age_minutes, origin_at, requested_target_at FROM ({OPEN}) o""")
add("occupancy_ratio_by_lot", f"""{P} SELECT terminal, lot_type, CAST(count(*) AS BIGINT) AS rows, round(avg(ratio), 6) AS mean_ratio,
 round(max(ratio), 6) AS max_ratio, CAST(count(*) FILTER (ratio > 1) AS BIGINT) AS over_capacity FROM ({OPEN}) o GROUP BY 1, 2""")


def cycle(local: str, hour: str) -> str:
    day = f"(isodow({local}) - 1)"
    return f"""round(sin({hour} * 2 * pi() / 24), 6) AS hour_sin, round(cos({hour} * 2 * pi() / 24), 6) AS hour_cos,
 round(sin({day} * 2 * pi() / 7), 6) AS weekday_sin, round(cos({day} * 2 * pi() / 7), 6) AS weekday_cos,
 CAST(CASE WHEN {day} >= 5 THEN 1 ELSE 0 END AS INT) AS is_weekend"""


CYCLE_HOURLY = cycle("(collected_at + INTERVAL '10' HOUR)", "(hour(collected_at + INTERVAL '10' HOUR) + minute(collected_at + INTERVAL '10' HOUR) / 60.0)")
add("cyclic_time_hourly", f"{P} SELECT id, {CYCLE_HOURLY} FROM parking WHERE total_spaces > 0")
CYCLE_DAY = cycle("(target_hour + INTERVAL '9' HOUR)", "hour(target_hour + INTERVAL '9' HOUR)")
add("cyclic_time_nextday", f"""{P}, h AS (SELECT DISTINCT lot_name, date_trunc('hour', observed_at) AS target_hour FROM parking WHERE total_spaces > 0)
SELECT lot_name, target_hour, {CYCLE_DAY} FROM h""")
LAST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lot_name ORDER BY collected_at DESC, observed_at DESC) AS r FROM parking) z WHERE r = 1"
add("latest_per_lot", f"{P} SELECT {PARK_COLUMNS} FROM ({LAST}) q")
add("semi_operating_lots", f"""{P} SELECT lot_name, CAST(count(*) AS BIGINT) AS rows FROM parking
WHERE lot_name IN (SELECT lot_name FROM ({LAST}) q WHERE total_spaces > 0) GROUP BY 1""")
add("latest_n_observations", f"""{P} SELECT lot_name, observed_at, occupied_spaces, total_spaces FROM parking
ORDER BY observed_at DESC, lot_name LIMIT 10""")
add("delta_range_scan", f"{RAW} SELECT * FROM park_raw WHERE id > 500 AND id <= 1000000400")
add("max_cursor", f"{RAW} SELECT CAST(coalesce(max(id), 0) AS BIGINT) AS max_cursor FROM park_raw")

# --- Truth -----------------------------------------------------------------


def truth_sql(src: str, as_of: str | None, minimum: int = 4) -> str:
    seen = f" AND collected_at <= {as_of} AND observed_at <= {as_of}" if as_of else ""
    ended = f" AND target_hour + INTERVAL '1' HOUR <= {as_of}" if as_of else ""
    known = f"(SELECT * FROM {src} WHERE total_spaces > 0{seen})"
    return f"""SELECT lot_name, target_hour,
 CASE WHEN slots >= {minimum}{ended} THEN mean END AS actual_ratio, CASE WHEN slots >= {minimum}{ended} THEN hi END AS actual_max_ratio,
 CASE WHEN slots >= {minimum}{ended} THEN lo END AS actual_min_ratio, CAST(slots AS INT) AS observation_slots, label_available_at
FROM (SELECT lot_name, date_trunc('hour', observed_at) AS target_hour, avg({RATIO}) AS mean, max({RATIO}) AS hi, min({RATIO}) AS lo,
  count(DISTINCT time_bucket(INTERVAL '10' MINUTE, observed_at)) AS slots, max(collected_at) AS label_available_at
 FROM ({DEDUP.format(src=known + ' k')}) q GROUP BY 1, 2) g"""


def rounded_truth(sql: str) -> str:
    return f"""SELECT lot_name, target_hour, round(actual_ratio, 6) AS actual_ratio, round(actual_max_ratio, 6) AS actual_max_ratio,
 round(actual_min_ratio, 6) AS actual_min_ratio, observation_slots, label_available_at FROM ({sql}) t"""


ASOF20 = "TIMESTAMP '2024-01-20 08:15:00'"
add("hourly_truth", f"{RAW} {rounded_truth(truth_sql('park_raw', None))}")
add("hourly_truth_as_of", f"{RAW} {rounded_truth(truth_sql('park_raw', ASOF20))}")
HISTORY = f"""SELECT lot_name, h + (shift + 1) * INTERVAL '1' DAY AS target_hour,
 max(CASE shift WHEN 0 THEN mean END) AS previous_day_same_hour, max(CASE shift WHEN 0 THEN hi END) AS previous_day_max,
 max(CASE shift WHEN 0 THEN lo END) AS previous_day_min, max(CASE shift WHEN 6 THEN mean END) AS previous_week_same_hour,
 max(CASE shift WHEN 6 THEN hi END) AS previous_week_max, max(CASE shift WHEN 6 THEN lo END) AS previous_week_min
FROM (SELECT lot_name, h, shift, avg(ratio) AS mean, max(ratio) AS hi, min(ratio) AS lo FROM (
  SELECT p.lot_name, date_trunc('hour', observed_at) AS h, s.shift, {RATIO} AS ratio, observed_at,
   CAST(CAST(observed_at + INTERVAL '9' HOUR AS DATE) AS TIMESTAMP) + s.shift * INTERVAL '1' DAY + {CUT} AS cutoff, collected_at
  FROM parking p CROSS JOIN (VALUES (0), (6)) s(shift) WHERE total_spaces > 0) e
 WHERE collected_at <= cutoff AND observed_at <= cutoff AND h + INTERVAL '1' HOUR <= cutoff
 GROUP BY 1, 2, 3 HAVING count(DISTINCT time_bucket(INTERVAL '10' MINUTE, observed_at)) >= 4) g GROUP BY 1, 2"""
HIST_COLUMNS = ["previous_day_same_hour", "previous_day_max", "previous_day_min",
                "previous_week_same_hour", "previous_week_max", "previous_week_min"]
add("same_hour_history", f"""{P} SELECT lot_name, target_hour, {', '.join(f'round({c}, 6) AS {c}' for c in HIST_COLUMNS)}
FROM ({HISTORY}) h""")

# --- As-of and nearest -----------------------------------------------------

LAG_CTES = f"""o AS ({OPEN}),
hist AS (SELECT * FROM (SELECT lot_name, collected_at, observed_at, CASE WHEN total_spaces > 0 THEN {RATIO} END AS ratio,
  row_number() OVER (PARTITION BY lot_name, collected_at ORDER BY observed_at DESC) AS r FROM parking) z WHERE r = 1),
want AS (SELECT o.id, o.lot_name, m.m, o.origin_at - m.m * INTERVAL '1' MINUTE AS want FROM o CROSS JOIN (VALUES (10), (30), (60)) m(m)),
hit AS (SELECT w.id, w.m, CASE WHEN epoch_us(w.want) - epoch_us(h.observed_at) <= 1200000000 THEN h.ratio END AS ratio
 FROM want w ASOF LEFT JOIN hist h ON w.lot_name = h.lot_name AND w.want >= h.collected_at),
lags AS (SELECT id, max(CASE m WHEN 10 THEN ratio END) AS l10, max(CASE m WHEN 30 THEN ratio END) AS l30,
  max(CASE m WHEN 60 THEN ratio END) AS l60 FROM hit GROUP BY 1)"""
LAG_COLUMNS = """round(l10, 6) AS lag_10_ratio, round(l30, 6) AS lag_30_ratio, round(l60, 6) AS lag_60_ratio,
 round(ratio - l30, 6) AS change_30, round(ratio - l60, 6) AS change_60"""
add("asof_lag", f"""{P}, {LAG_CTES}
SELECT o.id, lot_name, origin_at, round(ratio, 6) AS current_ratio, {LAG_COLUMNS} FROM o JOIN lags USING (id)""")
PV = duckdb_with("parking", "vintages")
FORECAST_CTES = """fq AS (SELECT o.id, o.terminal, o.origin_at, p.p, d.d,
  date_trunc('hour', CASE p.p WHEN 'now' THEN o.origin_at ELSE o.requested_target_at END) AS target_hour
 FROM o CROSS JOIN (VALUES ('now'), ('target')) p(p) CROSS JOIN (VALUES ('arrival'), ('departure')) d(d)),
fhit AS (SELECT q.id, q.p, q.d, v.expected_passengers AS x, v.fetched_at AS f FROM fq q ASOF LEFT JOIN vintages v
 ON q.terminal = v.terminal AND q.d = v.direction AND q.target_hour = v.target_hour AND q.origin_at >= v.fetched_at),
fc AS (SELECT id, CAST(max(x) FILTER (p = 'now' AND d = 'arrival') AS INT) AS passengers_now_arrival,
 CAST(max(x) FILTER (p = 'now' AND d = 'departure') AS INT) AS passengers_now_departure,
 CAST(max(x) FILTER (p = 'target' AND d = 'arrival') AS INT) AS passengers_target_arrival,
 CAST(max(x) FILTER (p = 'target' AND d = 'departure') AS INT) AS passengers_target_departure,
 max(f) AS latest_forecast_used_at FROM fhit GROUP BY 1)"""
FORECAST_NAMES = "passengers_now_arrival, passengers_now_departure, passengers_target_arrival, passengers_target_departure, latest_forecast_used_at"
add("asof_forecast", f"""{PV}, o AS ({OPEN}), {FORECAST_CTES}
SELECT o.id, o.terminal, o.origin_at, {FORECAST_NAMES} FROM o JOIN fc USING (id)""")
add("build_features", f"""{PV}, {LAG_CTES}, {FORECAST_CTES}
SELECT o.id, origin_at, lot_name, terminal, lot_type, round(ratio, 6) AS current_ratio, occupied_spaces, total_spaces,
 {mins('observed_at', 'origin_at')} AS observation_age_minutes, {LAG_COLUMNS}, {CYCLE_HOURLY}, {FORECAST_NAMES}
FROM o JOIN lags USING (id) JOIN fc USING (id)""")
add("forecast_feature_coverage", f"""{PV}, o AS ({OPEN}), {FORECAST_CTES}
SELECT round(avg(CASE WHEN passengers_target_arrival IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS forecast_feature_coverage_pct FROM fc""")
# Nearest reading through all readings within ten minutes.
LABEL_CTES = f"""o AS ({OPEN}),
cand AS (SELECT o.id, t.observed_at, t.collected_at, t.ratio, t.total_spaces, row_number() OVER (PARTITION BY o.id
   ORDER BY abs(epoch_us(t.observed_at) - epoch_us(o.requested_target_at)), t.observed_at) AS r
 FROM o JOIN o t ON o.lot_name = t.lot_name AND t.observed_at BETWEEN o.requested_target_at - INTERVAL '10' MINUTE
   AND o.requested_target_at + INTERVAL '10' MINUTE),
lab AS (SELECT o.id, o.lot_name, o.origin_at, o.requested_target_at, o.ratio AS current_ratio,
 CASE WHEN c.observed_at > o.origin_at AND c.collected_at > o.origin_at THEN c.observed_at END AS actual_observed_at,
 CASE WHEN c.observed_at > o.origin_at AND c.collected_at > o.origin_at THEN c.collected_at END AS label_available_at,
 CASE WHEN c.observed_at > o.origin_at AND c.collected_at > o.origin_at THEN c.ratio END AS actual_ratio,
 CASE WHEN c.observed_at > o.origin_at AND c.collected_at > o.origin_at THEN c.total_spaces END AS actual_capacity
 FROM o LEFT JOIN cand c ON o.id = c.id AND c.r = 1)"""
add("nearest_label", f"""{P}, {LABEL_CTES} SELECT id, lot_name, origin_at, requested_target_at, round(current_ratio, 6) AS current_ratio,
 actual_observed_at, label_available_at, round(actual_ratio, 6) AS actual_ratio, actual_capacity FROM lab""")
add("label_required", f"""{P}, {LABEL_CTES} SELECT lot_name, CAST(count(*) AS BIGINT) AS labelled, round(avg(actual_ratio), 6) AS mean_actual
FROM lab WHERE actual_ratio IS NOT NULL GROUP BY 1""")
ISSUES = f"""SELECT DISTINCT CAST(target_hour + INTERVAL '9' HOUR AS DATE) - 1 AS issue_date,
 CAST(CAST(target_hour + INTERVAL '9' HOUR AS DATE) AS TIMESTAMP) - INTERVAL '1' DAY + {CUT} AS cutoff FROM vintages"""
ANCHORS = """SELECT * FROM (SELECT i.issue_date, i.cutoff, p.*, row_number() OVER (PARTITION BY i.issue_date, p.lot_name
   ORDER BY p.collected_at DESC, p.observed_at DESC) AS r
 FROM issues i JOIN parking p ON p.collected_at <= i.cutoff AND p.observed_at <= i.cutoff) z WHERE r = 1"""
add("latest_anchor", f"""{PV}, issues AS ({ISSUES})
SELECT issue_date, lot_name, collected_at AS anchor_collected_at, observed_at AS anchor_observed_at, occupied_spaces, total_spaces
FROM ({ANCHORS}) a""")

add("latest_anchor_state", ORACLES["latest_anchor"])
add("truth_incremental", f"{P} {rounded_truth(truth_sql('parking', None))}")
add("history_from_summary", ORACLES["same_hour_history"])

# --- Vintages --------------------------------------------------------------

V = duckdb_with("vintages")
KEYS = "target_hour, terminal, direction"
JOINED = f"""SELECT f.batch_id, {KEYS}, expected_passengers, b.fetched_at, b.phase FROM vintages f
JOIN (SELECT batch_id, min(fetched_at) AS fetched_at, min(phase) AS phase FROM vintages GROUP BY 1) b ON f.batch_id = b.batch_id"""
add("join_batches", f"{V} {JOINED}")
add("latest_n_forecasts", f"{V} {JOINED} ORDER BY b.fetched_at DESC, target_hour, terminal, direction LIMIT 20")
add("plain_limit", f"{V} SELECT batch_id, {KEYS}, expected_passengers FROM vintages ORDER BY batch_id, {KEYS}, expected_passengers LIMIT 1000")
TD = "CAST(target_hour + INTERVAL '9' HOUR AS DATE)"
DAY_CUT = f"(CAST({TD} AS TIMESTAMP) - INTERVAL '1' DAY + {CUT})"


def windowed(minutes: int | None = 5) -> str:
    recent = f" AND fetched_at >= {DAY_CUT} - INTERVAL '{minutes}' MINUTE" if minutes else ""
    return f"SELECT *, {TD} AS td FROM vintages WHERE day_offset = 1 AND fetched_at <= {DAY_CUT}{recent}"


def batches_sql(minutes: int | None = 5) -> str:
    return f"""SELECT td AS target_date, arg_max(batch_id, (f, batch_id)) AS forecast_batch_id, max(f) AS forecast_fetched_at FROM (
 SELECT td, batch_id, min(fetched_at) AS f FROM ({windowed(minutes)}) w GROUP BY 1, 2
 HAVING count(*) = 96 AND count(DISTINCT (target_hour, terminal, direction)) = 96 AND count(DISTINCT fetched_at) = 1) g GROUP BY 1"""


add("batch_complete", f"{V} {batches_sql()}")
add("batch_window_filter", f"{V} SELECT batch_id, fetched_at, {KEYS}, expected_passengers FROM ({windowed()}) w")
add("key_set_equal", f"""{V} SELECT {TD} AS target_date, batch_id, CAST(96 - count(DISTINCT ({KEYS})) AS INT) AS missing_keys,
 CAST(count(*) - count(DISTINCT ({KEYS})) AS BIGINT) AS extra_rows, count(*) = 96 AND count(DISTINCT ({KEYS})) = 96 AS equal
FROM vintages GROUP BY 1, 2""")
add("batch_shape_valid", f"""{V}, s AS (SELECT batch_id, count(*) AS n, count(DISTINCT ({KEYS})) AS k, count(DISTINCT {TD}) AS d,
  min(coalesce(target_date, {TD})) AS day FROM vintages GROUP BY 1)
SELECT 'batch is not 24 hours of four totals' AS rule, CAST(count(*) AS BIGINT) AS n FROM s WHERE s.n <> 96 HAVING count(*) > 0
UNION ALL SELECT 'batch repeats a key', count(*) FROM s WHERE s.n <> s.k HAVING count(*) > 0
UNION ALL SELECT 'batch spans several days', count(*) FROM s WHERE s.d <> 1 HAVING count(*) > 0
UNION ALL SELECT 'batch of an unknown phase', count(*) FROM s WHERE batch_id % 17 = 0 HAVING count(*) > 0
UNION ALL SELECT 'request asks twice for a day', count(*) FROM (SELECT batch_id // 30 AS r, day FROM s GROUP BY 1, 2 HAVING count(*) > 1) HAVING count(*) > 0""")
add("dedup_vintage", f"""{V} SELECT {KEYS}, fetched_at, min(expected_passengers) AS expected_passengers,
 count(DISTINCT expected_passengers) > 1 AS conflicting FROM vintages GROUP BY {KEYS}, fetched_at""")
DATES = f"""SELECT batch_id, coalesce(target_date, {TD}) AS for_date, min(fetched_at) AS fetched_at, min(phase) AS phase
FROM vintages GROUP BY 1, 2"""
add("exists_fallback", f"{V} {DATES}")
CHANGED = f"""SELECT h.for_date, h.batch_id, h.previous_batch_id, h.fetched_at, h.phase,
 CAST(count(*) FILTER (c.expected_passengers IS DISTINCT FROM p.expected_passengers) AS INT) AS changed_count
FROM (SELECT *, lag(batch_id) OVER (PARTITION BY for_date ORDER BY fetched_at, batch_id) AS previous_batch_id FROM ({DATES}) d) h
JOIN vintages c ON c.batch_id = h.batch_id AND coalesce(c.target_date, CAST(c.target_hour + INTERVAL '9' HOUR AS DATE)) = h.for_date
LEFT JOIN vintages p ON p.batch_id = h.previous_batch_id AND p.target_hour = c.target_hour AND p.terminal = c.terminal AND p.direction = c.direction
GROUP BY 1, 2, 3, 4, 5"""
add("changed_count", f"{V} {CHANGED}")
add("revision_filter", f"""{V} SELECT for_date, batch_id, changed_count FROM ({CHANGED}) c
WHERE previous_batch_id IS NULL OR phase = 'baseline' OR changed_count > 0""")
add("pivot_direction", f"""{V} SELECT batch_id, terminal, target_hour, max(expected_passengers) FILTER (direction = 'arrival') AS arrival,
 max(expected_passengers) FILTER (direction = 'departure') AS departure FROM vintages GROUP BY 1, 2, 3""")


def pax_sql(minutes: int | None = 5) -> str:
    """Neighbouring-hour sums by time range, not by row position."""
    return f"""SELECT target_date, forecast_batch_id, forecast_fetched_at, terminal, target_hour, arrival, departure,
 CAST(coalesce(sum(arrival) OVER (w RANGE BETWEEN INTERVAL '2' HOUR PRECEDING AND INTERVAL '1' HOUR PRECEDING), 0) AS BIGINT) AS arrival_previous_2h,
 CAST(coalesce(sum(departure) OVER (w RANGE BETWEEN INTERVAL '1' HOUR FOLLOWING AND INTERVAL '2' HOUR FOLLOWING), 0) AS BIGINT) AS departure_next_2h,
 CAST(sum(arrival) OVER (w RANGE UNBOUNDED PRECEDING) AS BIGINT) AS arrival_cumulative,
 CAST(sum(departure) OVER (w RANGE UNBOUNDED PRECEDING) AS BIGINT) AS departure_cumulative,
 CAST(sum(arrival) OVER (PARTITION BY target_date, terminal) AS BIGINT) AS arrival_daily,
 CAST(sum(departure) OVER (PARTITION BY target_date, terminal) AS BIGINT) AS departure_daily
FROM (SELECT b.target_date, b.forecast_batch_id, b.forecast_fetched_at, terminal, target_hour,
  max(expected_passengers) FILTER (direction = 'arrival') AS arrival, max(expected_passengers) FILTER (direction = 'departure') AS departure
 FROM ({windowed(minutes)}) r JOIN ({batches_sql(minutes)}) b ON r.batch_id = b.forecast_batch_id AND r.td = b.target_date
 GROUP BY 1, 2, 3, 4, 5) x WINDOW w AS (PARTITION BY target_date, terminal ORDER BY target_hour)"""


add("passenger_day_features", f"{V} {pax_sql()}")

# --- Context ---------------------------------------------------------------

C = duckdb_with("headers")
DAYS = "SELECT DISTINCT target_date FROM flights"
GRID = """SELECT target_date, CAST(target_date AS TIMESTAMP) + h * INTERVAL '1' HOUR - INTERVAL '9' HOUR AS target_hour, terminal
FROM days CROSS JOIN (SELECT unnest(range(24)) AS h) hh CROSS JOIN (VALUES ('T1'), ('T2')) t(terminal)"""
add("calendar_grid", f"""{duckdb_with('flights')}, days AS ({DAYS})
SELECT g.*, direction FROM ({GRID}) g CROSS JOIN (VALUES ('arrival'), ('departure')) d(direction)""")
add("snapshot_inventory", f"""{C}, n AS (SELECT snapshot_id, count(*) AS c FROM (SELECT snapshot_id FROM flights UNION ALL SELECT snapshot_id FROM holidays) r GROUP BY 1)
SELECT kind, CAST(count(*) AS BIGINT) AS snapshots, max(fetched_at) AS last_fetched_at, CAST(sum(coalesce(c, 0)) AS BIGINT) AS records
FROM headers LEFT JOIN n ON id = snapshot_id GROUP BY 1""")
LATEST = f"""SELECT target_date, direction, arg_max(id, (fetched_at, id)) AS snapshot_id, max(fetched_at) AS fetched_at FROM headers
WHERE kind = 'flights' AND time_basis = 'scheduled' AND fetched_at <= CAST(target_date AS TIMESTAMP) - INTERVAL '1' DAY + {CUT}
 AND fetched_at >= CAST(target_date AS TIMESTAMP) - INTERVAL '1' DAY + {CUT} - INTERVAL '12' HOUR GROUP BY 1, 2"""
add("latest_snapshot", f"{C} {LATEST}")
PHYSICAL = """SELECT * FROM (SELECT *, coalesce(nullif(master_flight_id, ''), flight_id) AS flight, row_number() OVER (
  PARTITION BY snapshot_id, coalesce(nullif(master_flight_id, ''), flight_id), scheduled_text
  ORDER BY lower(codeshare) = 'slave', pos, flight_id, terminal_id, remark) AS r FROM flights) z WHERE r = 1"""
add("codeshare_collapse", f"""{duckdb_with('flights')} SELECT snapshot_id, flight, scheduled_text, pos, flight_id, terminal_id, remark
FROM ({PHYSICAL}) p""")
add("flight_problems", f"""{C}, k AS (SELECT f.*, CAST(regexp_extract(flight_id, 'F(\\d+)', 1) AS BIGINT) AS k FROM flights f
  WHERE snapshot_id IN (SELECT snapshot_id FROM ({LATEST}) l)),
r AS (SELECT target_date, CASE WHEN codeshare = 'Slave' AND k % 1009 = 7 THEN 'codeshare flight without its master' END AS problem FROM k
 UNION ALL SELECT target_date, CASE WHEN k % 1013 = 8 THEN 'unknown flight terminal' WHEN k % 1019 = 9 THEN 'malformed schedule time' END FROM k)
SELECT target_date, min(problem) AS problem FROM r WHERE problem IS NOT NULL GROUP BY 1""")
COUNTS = f"""SELECT l.target_date, l.direction, CASE WHEN terminal_id IN ('P01', 'P02') THEN 'T1' ELSE 'T2' END AS terminal,
 date_trunc('hour', strptime(scheduled_text, '%Y%m%d%H%M')) - INTERVAL '9' HOUR AS target_hour,
 CAST(count(*) FILTER (NOT (remark LIKE '%결항%' OR lower(remark) LIKE '%cancel%')) AS BIGINT) AS operating,
 CAST(count(*) FILTER (remark LIKE '%결항%' OR lower(remark) LIKE '%cancel%') AS BIGINT) AS cancelled
FROM ({PHYSICAL}) p JOIN ({LATEST}) l ON p.snapshot_id = l.snapshot_id GROUP BY 1, 2, 3, 4"""
add("flight_hourly_counts", f"{C} {COUNTS}")
FLIGHT_CTES = f"""latest AS ({LATEST}), counts AS ({COUNTS}), grid AS ({GRID}),
fwide AS (SELECT g.target_date, g.terminal, g.target_hour, a.snapshot_id AS flight_arrival_batch_id, a.fetched_at AS flight_arrival_fetched_at,
 d.snapshot_id AS flight_departure_batch_id, d.fetched_at AS flight_departure_fetched_at,
 CASE WHEN a.snapshot_id IS NOT NULL THEN coalesce(ca.operating, 0) END AS flight_arrival,
 CASE WHEN d.snapshot_id IS NOT NULL THEN coalesce(cd.operating, 0) END AS flight_departure,
 CASE WHEN a.snapshot_id IS NOT NULL THEN coalesce(ca.cancelled, 0) END AS flight_cancelled_arrival,
 CASE WHEN d.snapshot_id IS NOT NULL THEN coalesce(cd.cancelled, 0) END AS flight_cancelled_departure
 FROM grid g LEFT JOIN latest a ON a.target_date = g.target_date AND a.direction = 'arrival'
 LEFT JOIN latest d ON d.target_date = g.target_date AND d.direction = 'departure'
 LEFT JOIN counts ca ON ca.target_date = g.target_date AND ca.terminal = g.terminal AND ca.target_hour = g.target_hour AND ca.direction = 'arrival'
 LEFT JOIN counts cd ON cd.target_date = g.target_date AND cd.terminal = g.terminal AND cd.target_hour = g.target_hour AND cd.direction = 'departure'),
fday AS (SELECT *, CAST(CASE WHEN flight_arrival_batch_id IS NULL THEN 0 ELSE 1 END AS INT) AS flight_arrival_available,
 CAST(CASE WHEN flight_departure_batch_id IS NULL THEN 0 ELSE 1 END AS INT) AS flight_departure_available,
 CAST(CASE WHEN flight_arrival_batch_id IS NOT NULL THEN coalesce(lag(flight_arrival, 1) OVER w, 0) + coalesce(lag(flight_arrival, 2) OVER w, 0) END AS BIGINT) AS flight_arrival_previous_2h,
 CAST(CASE WHEN flight_departure_batch_id IS NOT NULL THEN coalesce(lead(flight_departure, 1) OVER w, 0) + coalesce(lead(flight_departure, 2) OVER w, 0) END AS BIGINT) AS flight_departure_next_2h,
 CAST(sum(flight_arrival) OVER (w RANGE UNBOUNDED PRECEDING) AS BIGINT) AS flight_arrival_cumulative,
 CAST(sum(flight_departure) OVER (w RANGE UNBOUNDED PRECEDING) AS BIGINT) AS flight_departure_cumulative,
 CAST(sum(flight_arrival) OVER (PARTITION BY target_date, terminal) AS BIGINT) AS flight_arrival_daily,
 CAST(sum(flight_departure) OVER (PARTITION BY target_date, terminal) AS BIGINT) AS flight_departure_daily
 FROM fwide WINDOW w AS (PARTITION BY target_date, terminal ORDER BY target_hour))"""
add("flight_day_features", f"{C}, days AS ({DAYS}), {FLIGHT_CTES} SELECT * FROM fday")
HOLIDAY_CTES = f"""cal AS (SELECT days.target_date, m.role, days.target_date + m.shift AS day,
   (SELECT h.id FROM headers h WHERE h.kind = 'holidays' AND h.year = year(days.target_date + m.shift) AND h.month = month(days.target_date + m.shift)
     AND h.fetched_at <= CAST(days.target_date AS TIMESTAMP) - INTERVAL '1' DAY + {CUT} ORDER BY h.fetched_at DESC, h.id DESC LIMIT 1) AS sid
 FROM days CROSS JOIN (VALUES ('own', 0), ('eve', 1), ('after', -1)) m(role, shift)),
marked AS (SELECT DISTINCT snapshot_id, locdate FROM holidays WHERE is_holiday = 'Y'),
hflag AS (SELECT cal.*, CAST(CASE WHEN sid IS NULL THEN NULL WHEN y.snapshot_id IS NULL THEN 0 ELSE 1 END AS INT) AS f
 FROM cal LEFT JOIN marked y ON y.snapshot_id = cal.sid AND y.locdate = cal.day),
hol AS (SELECT target_date, max(f) FILTER (role = 'own') AS is_holiday, max(f) FILTER (role = 'eve') AS holiday_eve,
 max(f) FILTER (role = 'after') AS day_after_holiday,
 CASE WHEN isodow(target_date) >= 6 THEN 1 ELSE max(f) FILTER (role = 'own') END AS is_day_off,
 CAST(CASE WHEN max(sid) FILTER (role = 'own') IS NULL THEN 0 ELSE 1 END AS INT) AS holiday_available,
 max(sid) FILTER (role = 'own') AS holiday_batch_id FROM hflag GROUP BY 1)"""
add("holiday_flags", f"""{C}, days AS ({DAYS}), {HOLIDAY_CTES}
SELECT hol.*, h.fetched_at AS holiday_fetched_at FROM hol LEFT JOIN headers h ON h.id = hol.holiday_batch_id AND h.kind = 'holidays'""")

# --- Next-day frames -------------------------------------------------------

ALL = duckdb_with("parking", "vintages", "headers")


def build_ctes(minutes: int | None = 5) -> str:
    return f"""issues AS ({ISSUES}), days AS (SELECT issue_date + 1 AS target_date FROM issues), {FLIGHT_CTES}, {HOLIDAY_CTES},
anchors AS ({ANCHORS}), pax AS ({pax_sql(minutes)}), history AS ({HISTORY}),
rows0 AS (SELECT a.issue_date, a.issue_date + 1 AS target_date, a.cutoff AS origin_at, x.target_hour, a.lot_name, x.terminal,
  {LOT_TYPE} AS lot_type, {RATIO} AS current_ratio, total_spaces AS current_capacity, a.observed_at AS anchor_observed_at,
  a.collected_at AS anchor_collected_at, {mins('a.observed_at', 'a.cutoff')} AS anchor_age_minutes,
  {sec('a.cutoff', 'x.target_hour')} / 3600 AS lead_hours, x.* EXCLUDE (target_date, terminal, target_hour)
 FROM anchors a JOIN pax x ON x.target_date = a.issue_date + 1 AND x.terminal = left(a.lot_name, 2) WHERE a.total_spaces > 0),
built AS (SELECT r.*, {CYCLE_DAY.replace('target_hour', 'r.target_hour')}, h.* EXCLUDE (lot_name, target_hour),
  f.* EXCLUDE (target_date, terminal, target_hour), hol.* EXCLUDE (target_date)
 FROM rows0 r LEFT JOIN history h ON h.lot_name = r.lot_name AND h.target_hour = r.target_hour
 LEFT JOIN fday f ON f.target_date = r.target_date AND f.terminal = r.terminal AND f.target_hour = r.target_hour
 LEFT JOIN hol ON hol.target_date = r.target_date)"""


CATEGORICAL = ["lot_name", "terminal", "lot_type"]
BASE = ["current_ratio", "current_capacity", "anchor_age_minutes", "lead_hours", "hour_sin", "hour_cos", "weekday_sin",
        "weekday_cos", "is_weekend", *HIST_COLUMNS, "arrival", "departure", "arrival_previous_2h", "departure_next_2h",
        "arrival_cumulative", "departure_cumulative", "arrival_daily", "departure_daily"]
CONTEXT = ["is_holiday", "holiday_eve", "day_after_holiday", "is_day_off", "holiday_available", "flight_arrival_available",
           "flight_departure_available", "flight_arrival", "flight_departure", "flight_cancelled_arrival",
           "flight_cancelled_departure", "flight_arrival_previous_2h", "flight_departure_next_2h", "flight_arrival_cumulative",
           "flight_departure_cumulative", "flight_arrival_daily", "flight_departure_daily"]
DOUBLES = {"current_ratio", "lead_hours", *HIST_COLUMNS}
BUILT = ", ".join(
    [f"round({c}, 6) AS {c}" if c in DOUBLES else c for c in
     ["issue_date", "target_date", "origin_at", "target_hour", "anchor_observed_at", "anchor_collected_at",
      "forecast_batch_id", "forecast_fetched_at", *CATEGORICAL, *BASE, *CONTEXT]]
)
add("build_day", f"{ALL}, {build_ctes(None)} SELECT {BUILT} FROM built")
add("build_one_day", f"{ALL}, {build_ctes(None)} SELECT {BUILT} FROM built WHERE issue_date = DATE '2024-01-15'")
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def training_ctes(minimum: int = 4) -> str:
    return f"""{build_ctes()}, truth AS ({truth_sql('parking', AS_OF, minimum)}),
training AS (SELECT b.*, t.* EXCLUDE (lot_name, target_hour) FROM built b
 JOIN truth t ON t.lot_name = b.lot_name AND t.target_hour = b.target_hour
 WHERE b.origin_at < {AS_OF} AND b.anchor_age_minutes <= 20 AND t.actual_ratio IS NOT NULL)"""


T = f"{ALL}, {training_ctes()}"
add("build_training", f"""{T} SELECT {BUILT}, round(actual_ratio, 6) AS actual_ratio, round(actual_max_ratio, 6) AS actual_max_ratio,
 round(actual_min_ratio, 6) AS actual_min_ratio, observation_slots, label_available_at FROM training""")
add("skipped_days", f"""{ALL}, issues AS ({ISSUES}), anchors AS ({ANCHORS}), b AS ({batches_sql()})
SELECT i.issue_date + 1 AS target_date, CASE WHEN b.target_date IS NULL THEN 'no complete day-ahead passenger batch'
 ELSE 'no parking observations at the cutoff' END AS reason
FROM issues i LEFT JOIN b ON b.target_date = i.issue_date + 1
WHERE i.cutoff < {AS_OF} AND (b.target_date IS NULL OR NOT EXISTS (
 SELECT 1 FROM anchors a WHERE a.issue_date = i.issue_date AND a.total_spaces > 0))""")
add("context_coverage", f"""{ALL}, {build_ctes()}
SELECT n.name, CAST(count(*) FILTER (CASE n.name WHEN 'holiday_available' THEN holiday_available
  WHEN 'flight_arrival_available' THEN flight_arrival_available ELSE flight_departure_available END = 1) AS BIGINT) AS available_rows,
 CAST(count(*) AS BIGINT) AS total_rows
FROM built CROSS JOIN (VALUES ('holiday_available'), ('flight_arrival_available'), ('flight_departure_available')) n(name) GROUP BY 1""")
T1 = f"{ALL}, {training_ctes(1)}"
COMPLETE = "SELECT target_date FROM training GROUP BY 1 HAVING count(DISTINCT target_hour) = 24"
add("complete_target_days", f"{T1} {COMPLETE}")

# --- Splits, baselines, scoring --------------------------------------------

SPLIT_CTES = f"""{LABEL_CTES}, ds AS (SELECT * FROM lab WHERE actual_ratio IS NOT NULL),
times AS (SELECT origin_at, row_number() OVER (ORDER BY origin_at) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT origin_at FROM ds) d),
bounds AS (SELECT max(n) AS n, max(origin_at) FILTER (k = CAST(floor(CAST(n AS DOUBLE) * 0.6) AS BIGINT)) AS v,
  max(origin_at) FILTER (k = CAST(floor(CAST(n AS DOUBLE) * 0.8) AS BIGINT)) AS t FROM times),
split AS (SELECT ds.*, CASE WHEN origin_at >= b.t THEN 'test' WHEN origin_at >= b.v AND label_available_at < b.t THEN 'validation'
  WHEN origin_at < b.v AND label_available_at < b.v THEN 'train' END AS split FROM ds CROSS JOIN bounds b)"""
add("temporal_split", f"{P}, {SPLIT_CTES} SELECT id, origin_at, label_available_at, split FROM split")
add("split_boundaries", f"{P}, {SPLIT_CTES} SELECT CAST(n AS BIGINT) AS prediction_times, v AS validation_start, t AS test_start FROM bounds")
add("split_sizes", f"""{P}, {SPLIT_CTES} SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT origin_at) AS BIGINT) AS prediction_times,
 min(origin_at) AS first_origin_at, max(origin_at) AS last_origin_at FROM split WHERE split IS NOT NULL GROUP BY 1""")
READY = "SELECT rule, round(found, 6) AS found, least, found >= least AS met FROM (VALUES {rows}) r(rule, found, least)"


def ready_sql(rules: dict[str, tuple[str, float]]) -> str:
    return READY.format(rows=", ".join(
        f"('{rule}', CAST(coalesce(({found}), 0) AS DOUBLE), CAST({least} AS DOUBLE))" for rule, (found, least) in rules.items()))


TIMES_OF = "SELECT count(DISTINCT origin_at) FROM split WHERE split = '{name}'"
add("readiness_hourly", f"{P}, {SPLIT_CTES} " + ready_sql({
    "labelled rows": ("SELECT count(*) FROM ds", 1),
    "days spanned by labels": ("SELECT (epoch_us(max(origin_at)) - epoch_us(min(origin_at))) / 86400000000.0 FROM ds", 7),
    "local days with labels": ("SELECT count(DISTINCT CAST(origin_at + INTERVAL '9' HOUR AS DATE)) FROM ds", 7),
    "prediction times": ("SELECT count(DISTINCT origin_at) FROM ds", 5),
    **{f"prediction times of {n}": (TIMES_OF.format(name=n), k) for n, k in (("train", 48), ("validation", 12), ("test", 12))},
}))
add("readiness_nextday", f"{T1} " + ready_sql({
    "training rows": ("SELECT count(*) FROM training", 1), "target days with every hour": (f"SELECT count(*) FROM ({COMPLETE}) c", 28)}))
DAY_CTES = f"""cd AS (SELECT target_date, row_number() OVER (ORDER BY target_date DESC) AS age FROM ({COMPLETE}) c),
tagged AS (SELECT t.*, CASE WHEN age <= 7 THEN 'test' WHEN age <= 14 THEN 'validation' ELSE 'train' END AS s0
 FROM training t JOIN cd ON cd.target_date = t.target_date),
firsts AS (SELECT min(origin_at) FILTER (s0 = 'validation') AS v, min(origin_at) FILTER (s0 = 'test') AS t FROM tagged),
dsplit AS (SELECT g.*, CASE WHEN s0 = 'test' THEN 'test' WHEN s0 = 'validation' AND label_available_at <= f.t THEN 'validation'
  WHEN s0 = 'train' AND label_available_at <= f.v THEN 'train' END AS split FROM tagged g CROSS JOIN firsts f)"""
add("day_split", f"{T1}, {DAY_CTES} SELECT lot_name, target_hour, target_date, label_available_at, split FROM dsplit")
add("context_complete_days", f"""{T1}, {DAY_CTES} SELECT split, CAST(count(*) FILTER (ok) AS BIGINT) AS context_complete_days FROM (
 SELECT split, target_date, bool_and(coalesce(holiday_available = 1 AND flight_arrival_available = 1 AND flight_departure_available = 1, false)) AS ok
 FROM dsplit WHERE split IS NOT NULL GROUP BY 1, 2) d GROUP BY 1""")
SEASONAL = """coalesce(previous_week_same_hour, previous_day_same_hour, current_ratio) AS m0,
 coalesce(previous_week_max, previous_day_max, current_ratio) AS x0, coalesce(previous_week_min, previous_day_min, current_ratio) AS n0"""


def seasonal_sql(src: str) -> str:
    return f"""SELECT *, m0 AS predicted_ratio, greatest(x0, m0) AS predicted_max_ratio, least(n0, m0) AS predicted_min_ratio
FROM (SELECT *, {SEASONAL} FROM {src}) s"""


THREE = "round(predicted_ratio, 6) AS predicted_ratio, round(predicted_max_ratio, 6) AS predicted_max_ratio, round(predicted_min_ratio, 6) AS predicted_min_ratio"
add("persistence", f"""{T} SELECT lot_name, target_hour, round(current_ratio, 6) AS predicted_ratio, round(current_ratio, 6) AS predicted_max_ratio,
 round(current_ratio, 6) AS predicted_min_ratio FROM training""")
add("seasonal", f"{T} SELECT lot_name, target_hour, {THREE} FROM ({seasonal_sql('training')}) s")
add("nextday_outputs", f"""{ALL}, {build_ctes()}, r AS (SELECT issue_date, lot_name, target_hour, current_capacity, round(predicted_ratio, 8) AS pm,
 round(predicted_max_ratio, 8) AS px, round(predicted_min_ratio, 8) AS pn FROM ({seasonal_sql('built')}) s)
SELECT issue_date, lot_name, target_hour, round(pm * 100, 6) AS predicted_occupancy_pct, round(px * 100, 6) AS predicted_max_occupancy_pct,
 round(pn * 100, 6) AS predicted_min_occupancy_pct, CAST(round_even(pm * current_capacity, 0) AS INT) AS estimated_occupied_spaces,
 pm >= 0.9 AS predicted_busy, px >= 0.9 AS predicted_max_busy, 'seasonal' AS model, 'baseline' AS prediction_kind,
 false AS context_used_by_model, {AS_OF} AS generated_at, 'hourly_mean_max_min_ratio' AS target_definition FROM r""")
add("hourly_outputs", f"""{P}, o AS ({OPEN}), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lot_name ORDER BY origin_at DESC, observed_at DESC) AS r
 FROM o WHERE lot_name IN (SELECT lot_name FROM ({LAST}) q WHERE total_spaces > 0)) z WHERE r = 1)
SELECT lot_name, origin_at, observed_at, requested_target_at, total_spaces, round(ratio, 6) AS current_ratio, round(ratio, 6) AS predicted_ratio,
 round(ratio * 100, 6) AS predicted_occupancy_pct, occupied_spaces AS estimated_occupied_spaces, ratio >= 0.9 AS predicted_busy,
 'persistence' AS model, 'baseline' AS prediction_kind, {sec('origin_at', AS_OF)} / 60 > 20 AS stale_input FROM l""")
add("order_min_mean_max", f"""{T}, r AS (SELECT *, greatest(current_ratio - 0.3, 0.0) AS m0, greatest(actual_max_ratio - 0.4, 0.0) AS x0,
 greatest(actual_min_ratio + 0.1, 0.0) AS n0 FROM training)
SELECT lot_name, target_hour, round(m0, 6) AS predicted_ratio, round(greatest(x0, m0), 6) AS predicted_max_ratio,
 round(least(n0, m0), 6) AS predicted_min_ratio FROM r""")
add("forecast_metrics", f"{P}, {LABEL_CTES} SELECT {metric_sql('actual_ratio', 'current_ratio')} FROM lab WHERE actual_ratio IS NOT NULL")
add("per_lot_metrics", f"{P}, {LABEL_CTES} SELECT lot_name, 'persistence' AS model, {metric_sql('actual_ratio', 'current_ratio')} FROM lab WHERE actual_ratio IS NOT NULL GROUP BY 1"
    f" UNION ALL SELECT lot_name, 'damped', {metric_sql('actual_ratio', '(current_ratio * 0.9)')} FROM lab WHERE actual_ratio IS NOT NULL GROUP BY 1")


def statistics_sql(src: str, keep: str = "") -> str:
    """One row per statistic."""
    return f"""SELECT {keep}'mean' AS statistic, actual_ratio AS actual, predicted_ratio AS predicted FROM {src}
UNION ALL SELECT {keep}'max', actual_max_ratio, predicted_max_ratio FROM {src}
UNION ALL SELECT {keep}'min', actual_min_ratio, predicted_min_ratio FROM {src}"""


add("statistic_metrics", f"""{T}, s AS ({seasonal_sql('training')})
SELECT statistic, {metric_sql('actual', 'predicted')} FROM ({statistics_sql('s')}) u GROUP BY 1""")
FLAT = "SELECT *, current_ratio AS predicted_ratio, current_ratio AS predicted_max_ratio, current_ratio AS predicted_min_ratio FROM training"
GROUPS = {
    "all": "'all'", "lot": "lot_name", "hour": "CAST(hour(target_hour + INTERVAL '9' HOUR) AS VARCHAR)",
    "is_holiday": "CAST(is_holiday AS VARCHAR)", "is_day_off": "CAST(is_day_off AS VARCHAR)",
    "flight_arrival_available": "CAST(flight_arrival_available AS VARCHAR)",
    "flight_departure_available": "CAST(flight_departure_available AS VARCHAR)", "context_used_by_model": "'0'",
}
add("metrics_by_group", f"{T}, p AS ({FLAT}), " + "u AS (" + " UNION ALL ".join(
    statistics_sql("p", f"'{kind}' AS group_kind, {value} AS group_value, ") for kind, value in GROUPS.items()
) + f") SELECT group_kind, group_value, statistic, {metric_sql('actual', 'predicted')} FROM u GROUP BY 1, 2, 3")
EVAL_AT = "TIMESTAMP '2024-01-20 00:00:00'"
EVAL_CTES = f"""{build_ctes()}, issued AS ({seasonal_sql('built')}), truth AS ({truth_sql('parking', EVAL_AT)}),
checked AS (SELECT i.issue_date, i.target_date, i.lot_name, i.target_hour, i.predicted_ratio, i.predicted_max_ratio, i.predicted_min_ratio,
 i.current_ratio, i.holiday_available, i.flight_arrival_available, i.flight_departure_available, t.actual_ratio, t.actual_max_ratio, t.actual_min_ratio,
 CASE WHEN i.target_hour + INTERVAL '1' HOUR > {EVAL_AT} THEN 'pending' WHEN t.actual_ratio IS NOT NULL THEN 'matched' ELSE 'missing' END AS evaluation_status
 FROM issued i LEFT JOIN truth t ON t.lot_name = i.lot_name AND t.target_hour = i.target_hour)"""
add("evaluate_nextday", f"""{ALL}, {EVAL_CTES} SELECT issue_date, lot_name, target_hour, evaluation_status,
 round(abs(predicted_ratio - actual_ratio) * 100, 6) AS mean_absolute_error_percentage_points,
 round(abs(predicted_max_ratio - actual_max_ratio) * 100, 6) AS max_absolute_error_percentage_points,
 round(abs(predicted_min_ratio - actual_min_ratio) * 100, 6) AS min_absolute_error_percentage_points FROM checked""")


def summary_errors() -> list[str]:
    """Errors of forecast and persistence over the matched rows, and the rows with context."""
    ratio = {"mean": "ratio", "max": "max_ratio", "min": "min_ratio"}
    out = []
    for kind in ("forecast", "persistence"):
        for s, r in ratio.items():
            error = f"(actual_{r} - {f'predicted_{r}' if kind == 'forecast' else 'current_ratio'})"
            only = "FILTER (evaluation_status = 'matched')"
            out += [f"round(avg(abs({error})) {only} * 100, 6) AS {kind}_{s}_mae_percentage_points",
                    f"round(sqrt(avg({error} * {error}) {only}) * 100, 6) AS {kind}_{s}_rmse_percentage_points"]
    flags = ("holiday_available", "flight_arrival_available", "flight_departure_available")
    return out + [f"CAST(count(*) FILTER ({c} = 1) AS BIGINT) AS {c}_rows" for c in flags]


add("eval_summary_nextday", f"""{ALL}, {EVAL_CTES} SELECT issue_date, target_date,
 CASE WHEN max(target_hour) + INTERVAL '1' HOUR > {EVAL_AT} THEN 'partial' ELSE 'final' END AS status, CAST(count(*) AS BIGINT) AS prediction_rows,
 CAST(count(*) FILTER (evaluation_status = 'matched') AS BIGINT) AS matched_rows, CAST(count(*) FILTER (evaluation_status = 'pending') AS BIGINT) AS pending_rows,
 CAST(count(*) FILTER (evaluation_status = 'missing') AS BIGINT) AS missing_rows,
 round(count(*) FILTER (evaluation_status = 'matched') * 100.0 / count(*), 6) AS coverage_pct,
 {', '.join(summary_errors())} FROM checked GROUP BY 1, 2""")


def half_metrics(prefix: str, p: str) -> str:
    a = "actual_ratio"
    return f"""round(avg(abs({a} - {p})) FILTER ({a} IS NOT NULL) * 100, 6) AS {prefix}_mae_percentage_points,
 round(sqrt(avg(({a} - {p}) * ({a} - {p})) FILTER ({a} IS NOT NULL)) * 100, 6) AS {prefix}_rmse_percentage_points,
 round(coalesce(2.0 * count(*) FILTER ({a} >= 0.9 AND {p} >= 0.9) / nullif(2.0 * count(*) FILTER ({a} >= 0.9 AND {p} >= 0.9)
  + count(*) FILTER (({a} >= 0.9) <> ({p} >= 0.9)), 0), 0.0), 6) AS {prefix}_busy_f1"""


add("eval_summary_hourly", f"""{P}, {LABEL_CTES} SELECT CAST(count(*) AS BIGINT) AS prediction_rows, CAST(count(actual_ratio) AS BIGINT) AS matched_rows,
 CAST(count(*) - count(actual_ratio) AS BIGINT) AS pending_or_missing_rows, CAST(count(*) FILTER (actual_ratio >= 0.9) AS BIGINT) AS actual_busy_rows,
 CAST(90.0 AS DOUBLE) AS busy_threshold_pct, {half_metrics('forecast', '(current_ratio * 0.9)')},
 {half_metrics('baseline', 'current_ratio')} FROM lab""")
add("backtest_hourly_mean", f"""{P}, {LABEL_CTES} SELECT date_trunc('hour', origin_at + INTERVAL '9' HOUR) AS hour, round(avg(actual_ratio), 6) AS actual_ratio,
 round(avg(current_ratio), 6) AS persistence FROM lab WHERE actual_ratio IS NOT NULL GROUP BY 1""")
ERRORS = f"""pe AS ({FLAT}), se AS ({seasonal_sql('training')}),
e AS (SELECT 'persistence' AS model, 0 AS pos, statistic, avg(abs(actual - predicted)) * 100 AS mae FROM ({statistics_sql('pe')}) a GROUP BY 1, 2, 3
 UNION ALL SELECT 'seasonal', 1, statistic, avg(abs(actual - predicted)) * 100 FROM ({statistics_sql('se')}) b GROUP BY 1, 2, 3)"""
add("argmin_model", f"""{T}, {ERRORS} SELECT arg_min(model, (err, pos)) AS selected_model
FROM (SELECT model, pos, avg(mae) AS err FROM e GROUP BY 1, 2) m""")
add("improvement_pct", f"""{T}, {ERRORS} SELECT a.statistic, round(CASE WHEN a.mae > 0 THEN (a.mae - b.mae) / a.mae * 100 ELSE 0.0 END, 6) AS improvement_pct
FROM e a JOIN e b ON a.statistic = b.statistic WHERE a.model = 'persistence' AND b.model = 'seasonal'""")

# --- Store and streams -----------------------------------------------------

STORE_CTES = """stored AS (SELECT * FROM park_raw WHERE collected_at < TIMESTAMP '2024-01-20 00:00:00'),
delta AS (SELECT * FROM park_raw WHERE collected_at >= TIMESTAMP '2024-01-18 00:00:00')"""
add("merge_immutable", f"{RAW}, {STORE_CTES} SELECT * FROM delta WHERE id NOT IN (SELECT id FROM stored)")
add("delta_violations", f"""{RAW}, {STORE_CTES}, broken AS (SELECT id FROM delta UNION ALL SELECT id FROM delta WHERE id % 83 = 0)
SELECT 'stored row changed' AS rule, CAST(count(*) AS BIGINT) AS n FROM delta
 WHERE id IN (SELECT id FROM stored) AND id % 71 = 0 HAVING count(*) > 0
UNION ALL SELECT 'row outside the cursor range', count(*) FROM broken WHERE id <= 300 OR id > 1000000900 HAVING count(*) > 0
UNION ALL SELECT 'repeated key in the delta', count(*) FROM (SELECT id, count(*) OVER (PARTITION BY id) AS c FROM broken) z
 WHERE c > 1 HAVING count(*) > 0""")
add("sink_parking_insert_ignore", f"""{RAW}, {STORE_CTES}, firsts AS (SELECT *, row_number() OVER (PARTITION BY source, lot_name, observed_at
  ORDER BY collected_at, id) AS rn FROM delta)
SELECT {PARK_COLUMNS} FROM firsts f WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM stored s
 WHERE s.source = f.source AND s.lot_name = f.lot_name AND s.observed_at = f.observed_at)""")
add("sink_vintage_if_changed", f"""{V}, c AS ({CHANGED})
SELECT v.batch_id, {KEYS}, expected_passengers, c.changed_count FROM vintages v JOIN c ON c.batch_id = v.batch_id
WHERE v.fetched_at >= TIMESTAMP '2024-01-10 00:00:00'
 AND (c.previous_batch_id IS NULL OR c.phase = 'baseline' OR c.changed_count > 0)""")
add("stream_hourly_truth", f"{RAW} {rounded_truth(truth_sql('park_raw', None))}")
add("stream_dedup", f"{RAW} SELECT {PARK_COLUMNS} FROM ({DEDUP.format(src='park_raw')}) q")

def report_sql(rows: str, name: str, low: int) -> str:
    return f"""SELECT '{name}' AS delta, CAST(count(*) AS BIGINT) AS rows, min(id) AS least, max(id) AS largest,
 count(DISTINCT id) FILTER (id NOT IN (SELECT id FROM stored)) AS new_rows,
 count(DISTINCT id) FILTER (id IN (SELECT id FROM stored)) AS known_rows,
 count(DISTINCT id) FILTER (id IN (SELECT id FROM stored WHERE occupied_spaces <> b.occupied_spaces)) AS changed_rows,
 (SELECT count(*) FROM (SELECT id FROM {rows} GROUP BY id HAVING count(*) > 1) r) AS repeated_keys,
 count(DISTINCT id) FILTER (id <= {low} OR id > {1 << 40}) AS outside_rows, {str(name == 'clean').lower()} AS accepted FROM {rows} b"""


add("merge_checked", f"""{RAW}, {STORE_CTES},
changed AS (SELECT id, CASE WHEN id % 71 = 0 THEN occupied_spaces + 5 ELSE occupied_spaces END AS occupied_spaces FROM delta),
broken AS (SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE id % 83 = 0)
{report_sql('broken', 'broken', 9000)} UNION ALL {report_sql('delta', 'clean', 0)}""")
add("stream_ingest", f"{RAW} SELECT {PARK_COLUMNS} FROM park_raw")
# The watermark before a slice is the largest reading time of the slices before, less the lateness.
SLICES = " + ".join(f"CAST(collected_at >= TIMESTAMP '2024-01-{d:02d} 00:00:00' AS INT)" for d in (5, 9, 13, 17, 21, 25))
add("stream_late_rows", f"""{RAW}, s AS (SELECT *, {SLICES} AS slice FROM park_raw),
m AS (SELECT slice, max(max(observed_at)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '1' HOUR AS watermark
 FROM s GROUP BY slice),
late AS (SELECT lot_name, date_trunc('hour', observed_at) AS target_hour, CAST(count(*) AS BIGINT) AS late_rows, max(slice) AS last_epoch
 FROM s JOIN m USING (slice) WHERE observed_at < watermark GROUP BY 1, 2)
SELECT late.lot_name, late.target_hour, late_rows, CAST(last_epoch AS BIGINT) AS last_epoch, round(actual_ratio, 6) AS actual_ratio,
 round(actual_max_ratio, 6) AS actual_max_ratio, round(actual_min_ratio, 6) AS actual_min_ratio, observation_slots
FROM late LEFT JOIN ({truth_sql('park_raw', None)}) t ON t.lot_name = late.lot_name AND t.target_hour = late.target_hour""")

# --- Collection rules ------------------------------------------------------

K = "o_orderkey"
add("parse_passenger_payload", f"""SELECT {K} // 160 AS request_id,
 CASE WHEN {K} % 25 = 24 THEN '합계' ELSE strftime(CAST(o_orderdate AS DATE), '%Y%m%d') END AS adate,
 CASE WHEN {K} % 25 = 24 THEN '합계' WHEN {K} % 41 = 0 THEN '03_07'
  ELSE printf('%02d_%02d', {K} % 24, CASE WHEN {K} % 2 = 0 THEN {K} % 24 + 1 ELSE ({K} % 24 + 1) % 24 END) END AS atime,
 CAST({K} % 977 AS VARCHAR) AS t1egsum1, concat({K} % 613, '.0') AS t1dgsum1,
 CASE WHEN {K} % 37 = 0 THEN '-4' ELSE CAST(o_custkey % 500 AS VARCHAR) END AS t2egsum1,
 CASE WHEN {K} % 43 = 0 THEN '12.5' ELSE CAST(o_custkey % 300 AS VARCHAR) END AS t2dgsum2 FROM orders""")
add("passenger_date_rule", f"""SELECT 'response is dated differently from its request' AS rule, CAST(count(*) AS BIGINT) AS n
FROM orders WHERE {K} % 29 = 0 HAVING count(*) > 0""")
add("strict_timestamps", "SELECT event_id, date_trunc('second', ts) AS utc FROM events")


def rule_counts(src: str, rules: dict[str, str], n: str = "count(*)", key: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CAST({n} AS BIGINT) AS n{key} FROM {src} WHERE {broken} HAVING count(*) > 0" for rule, broken in rules.items())


add("passenger_domain", f"{V} " + rule_counts("vintages", {
    "unknown terminal": "batch_id % 13 = 0", "unknown direction": "batch_id % 17 = 0", "bad passenger count": "batch_id % 19 = 0",
}, key=", min(lpad(CAST(batch_id AS VARCHAR), 12, '0')) AS key"))
add("flight_snapshot_rules", f"""{C}, k AS (SELECT snapshot_id, flight_id, CAST(regexp_extract(flight_id, 'F(\\d+)', 1) AS BIGINT) AS k FROM flights
 WHERE snapshot_id IN (SELECT id FROM headers)),
g AS (SELECT count(*) AS c, k FROM (SELECT * FROM k UNION ALL SELECT * FROM k WHERE k % 1019 = 9) z GROUP BY snapshot_id, flight_id, k) """ + rule_counts("g", {
    "flight has no identity": "k % 1009 = 7", "flight listed twice": "c > 1",
    "scheduled on another day than its snapshot": "k % 1013 = 8"}))
add("holiday_snapshot_rules", f"""{C}, k AS (SELECT CAST(seq AS BIGINT) AS k FROM holidays WHERE snapshot_id IN (SELECT id FROM headers)) """ + rule_counts("k", {
    "holiday outside its month": "k % 101 = 5", "holiday without a Y or N flag": "k % 97 = 3", "repeated holiday": "k % 103 = 7"}))
add("sink_context_if_changed", f"""WITH s AS (SELECT {K} AS id, {K} // 7 % 12 AS scope, {K} // 900 % 3 AS v FROM orders WHERE {K} % 5 <> 0),
c AS (SELECT id, v IS DISTINCT FROM lag(v) OVER (PARTITION BY scope ORDER BY id) AS changed FROM s)
SELECT id, 'holidays' AS kind FROM c WHERE changed AND id % 10 >= 4
UNION ALL SELECT {K}, 'flights' FROM orders WHERE {K} % 5 = 0 AND {K} % 10 >= 4""")
add("merge_context", "WITH d AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 10 >= 4) " + rule_counts("d", {
    "row was stored before": "id % 10 < 6", "row outside the cursor range": "id <= 100"}))

# --- Models ----------------------------------------------------------------

MODEL_NUMERIC = ["current_ratio", "observation_age_minutes", "lag_10_ratio", "lag_60_ratio", "passengers_target_arrival", "hour_sin"]
GAPPED = ["lag_10_ratio", "lag_60_ratio", "passengers_target_arrival"]
FEATURES = ORACLES["build_features"].removeprefix(PV)
IMPUTED = [(c, f"coalesce({c}, (SELECT median({c}) FROM b))") for c in MODEL_NUMERIC]
IMPUTED += [(f"{c}_missing", f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END") for c in GAPPED]
add("preprocess", PV + FEATURES.replace("\nSELECT o.id", ", b AS (SELECT o.id", 1) + "), long AS (" + " UNION ALL ".join(
    # An indicator belongs to a column with gaps only.
    f"SELECT id, '{n}' AS feature, CAST({v} AS DOUBLE) AS raw FROM b"
    + (f" WHERE (SELECT count(*) FROM b WHERE {n.removesuffix('_missing')} IS NULL) > 0" if n.endswith("_missing") else "")
    for n, v in IMPUTED
) + """), m AS (SELECT feature, avg(raw) AS mean, CASE WHEN stddev_pop(raw) > 1e-12 THEN stddev_pop(raw) ELSE 1.0 END AS scale FROM long GROUP BY 1)
SELECT id, feature, round((raw - mean) / scale, 5) AS value FROM long JOIN m USING (feature)""")
add("delta_text_rules", f"{RAW} " + rule_counts("park_raw", {
    "invalid identity": "id % 101 = 0 OR id % 103 = 0", "invalid count: occupied_spaces": "id % 107 = 0", "invalid count: total_spaces": "id % 109 = 0",
    "time without offset: observed_at": "id % 113 = 0", "time without offset: collected_at": "id % 127 = 0",
}))
