"""Explicit schemas of the tables; times are ``timestamp_ntz`` holding UTC."""

# Columns of the tables, in the order of the exchange files, and their keys.
PARKING = (
    "id bigint, source string, lot_name string, observed_at timestamp_ntz, "
    "collected_at timestamp_ntz, occupied_spaces int, total_spaces int"
)
PASSENGERS = (
    "batch_id bigint, source string, fetched_at timestamp_ntz, target_date date, "
    "day_offset int, phase string, changed_count int, target_hour timestamp_ntz, "
    "terminal string, direction string, expected_passengers int"
)
CONTEXT_HEADERS = (
    "id bigint, source string, kind string, fetched_at timestamp_ntz, target_date date, "
    "direction string, time_basis string, year int, month int"
)
FLIGHTS = (
    "snapshot_id bigint, pos int, fid string, flight_id string, master_flight_id string, "
    "codeshare string, terminal_id string, scheduled_text string, remark string"
)
HOLIDAYS = (
    "snapshot_id bigint, pos int, locdate date, is_holiday string, seq string, date_name string"
)

# Column order of the exchange files.
PARKING_CSV = ["id", "source", "lot_name", "observed_at", "collected_at", "occupied_spaces", "total_spaces"]
PASSENGERS_CSV = [
    "batch_id", "source", "fetched_at", "target_date", "day_offset", "phase", "changed_count",
    "target_hour", "terminal", "direction", "expected_passengers",
]
CONTEXT_CSV = ["id", "source", "kind", "fetched_at", "scope", "records"]

PARKING_KEY = ["id"]
PASSENGERS_KEY = ["batch_id", "target_hour", "terminal", "direction"]
CONTEXT_KEY = ["id"]
