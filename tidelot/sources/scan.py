"""Readers of the exchange files and Parquet tables, with strict checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelot import schemas
from tidelot.functions.time import parse_offset_timestamp
from tidelot.operators.quality import (
    DataQualityError, duplicate_violations, enforce, parking_rules, passenger_rules, require_columns,
    require_rows, violations,
)
from tidelot.operators.scoring import TARGET_DEFINITION
from tidelot.operators.vintages import vintage_conflicts
from tidelot.sources.fs import exists, is_inside, read_json

OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)$"


def resolve_latest(spark: SparkSession, root: str) -> str:
    """Folder named by the pointer file; it must stay inside ``root``."""
    folder = read_json(spark, f"{root}/latest.json")["dataset_dir"]
    if not is_inside(root, folder):
        raise DataQualityError("the latest dataset must be inside the data folder")
    return f"{root}/{folder}"


def _text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text; every file's header must match and every row be complete.

    ``multiLine`` is needed because names may hold line breaks; it reads each
    file in one task, so large exports should come as many files.
    """
    return (
        spark.read.schema(", ".join(f"{c} string" for c in columns))
        .option("header", True).option("enforceSchema", False).option("multiLine", True)
        .option("escape", '"').option("mode", "FAILFAST").csv(path)
    )


def _digits(name: str) -> Column:
    return ~F.coalesce(F.col(name).rlike(r"^\d+$"), F.lit(False))


def _no_offset(name: str) -> Column:
    return ~F.coalesce(F.col(name).rlike(OFFSET), F.lit(False))


def _identity(name: str) -> Column:
    return _digits(name) | ~F.coalesce(F.col(name).try_cast("bigint") > 0, F.lit(False))


def parking_text_rules() -> dict[str, Column]:
    """What makes a row of a parking delta unusable while all its columns are text."""
    return {
        "invalid identity": _identity("id"),
        **{f"invalid count: {c}": _digits(c) for c in ("occupied_spaces", "total_spaces")},
        **{f"time without offset: {c}": _no_offset(c) for c in ("observed_at", "collected_at")},
    }


def delta_parking(spark: SparkSession, path: str) -> DataFrame:
    """Strict reader of a parking delta; any malformed row fails the read."""
    text = _text_csv(spark, path, schemas.PARKING_CSV)
    enforce(violations(text, parking_text_rules(), F.col("id")))
    return text.select(
        F.col("id").cast("bigint"), "source", "lot_name",
        *[parse_offset_timestamp(F.col(c)).alias(c) for c in ("observed_at", "collected_at")],
        *[F.col(c).cast("int") for c in ("occupied_spaces", "total_spaces")],
    )


def delta_passengers(spark: SparkSession, path: str) -> DataFrame:
    """Strict reader of a forecast delta."""
    text = _text_csv(spark, path, schemas.PASSENGERS_CSV)
    enforce(violations(text, {
        "invalid identity": _identity("batch_id"),
        "invalid count: expected_passengers": _digits("expected_passengers"),
        **{f"time without offset: {c}": _no_offset(c) for c in ("target_hour", "fetched_at")},
        "unknown terminal": ~F.coalesce(F.col("terminal").isin("T1", "T2"), F.lit(False)),
        "unknown direction": ~F.coalesce(F.col("direction").isin("arrival", "departure"), F.lit(False)),
    }, F.col("batch_id")))
    return text.select(
        F.col("batch_id").cast("bigint"), "source", parse_offset_timestamp(F.col("fetched_at")).alias("fetched_at"),
        F.col("target_date").cast("date"), F.col("day_offset").cast("int"), "phase",
        F.col("changed_count").cast("int"),
        parse_offset_timestamp(F.col("target_hour")).alias("target_hour"),
        "terminal", "direction", F.col("expected_passengers").cast("int"),
    )


def delta_context(spark: SparkSession, path: str) -> DataFrame:
    """Strict reader of context snapshots; scope and records stay JSON text.

    The reader has no field-size limit; a snapshot is flattened right after.
    """
    text = _text_csv(spark, path, schemas.CONTEXT_CSV)
    shape = {c: F.schema_of_variant(F.try_parse_json(c)) for c in ("scope", "records")}
    enforce(
        violations(text, {
            "invalid identity": _identity("id"),
            "time without offset: fetched_at": _no_offset("fetched_at"),
            "unknown kind": ~F.coalesce(F.col("kind").isin("flights", "holidays"), F.lit(False)),
            "scope is not an object": ~F.coalesce(shape["scope"].startswith("OBJECT"), F.lit(False)),
            "records is not an array": ~F.coalesce(shape["records"].startswith("ARRAY"), F.lit(False)),
        }, F.col("id")),
        duplicate_violations(text, ["id"], "repeated context identity"),
    )
    return text.select(
        F.col("id").cast("bigint"), "source", "kind", parse_offset_timestamp(F.col("fetched_at")).alias("fetched_at"),
        "scope", "records",
    )


# Fields of the context JSON.
SCOPE = "target_date string, direction string, time_basis string, year int, month int"
RECORDS = (
    "array<struct<fid string, flightId string, masterflightid string, codeshare string, terminalid string, "
    "scheduleDateTime string, remark string, locdate string, isHoliday string, seq string, dateName string>>"
)


def flatten_context(snapshots: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Headers, flight records and holiday records of JSON snapshots."""
    scoped = snapshots.withColumn("_s", F.from_json("scope", SCOPE))
    headers = scoped.select(
        "id", "source", "kind", "fetched_at", F.col("_s.target_date").cast("date").alias("target_date"),
        "_s.direction", "_s.time_basis", "_s.year", "_s.month",
    )
    records = snapshots.select(
        F.col("id").alias("snapshot_id"), "kind", F.posexplode(F.from_json("records", RECORDS)).alias("pos", "r")
    )
    flights = records.where("kind = 'flights'").select(
        "snapshot_id", "pos", "r.fid", F.col("r.flightId").alias("flight_id"),
        F.col("r.masterflightid").alias("master_flight_id"), "r.codeshare",
        F.col("r.terminalid").alias("terminal_id"), F.col("r.scheduleDateTime").alias("scheduled_text"), "r.remark",
    )
    day = F.regexp_replace("r.locdate", r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")
    holidays = records.where("kind = 'holidays'").select(
        "snapshot_id", "pos", day.alias("locdate"), F.col("r.isHoliday").alias("is_holiday"), "r.seq",
        F.col("r.dateName").alias("date_name"),
    )
    return headers, flights, holidays


def scan_context(spark: SparkSession, dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Flattened context of a dataset; an absent file gives empty frames."""
    path = f"{dataset}/context_snapshots.csv"
    if not exists(spark, path):
        return tuple(
            spark.createDataFrame([], s) for s in (schemas.CONTEXT_HEADERS, schemas.FLIGHTS, schemas.HOLIDAYS)
        )
    return flatten_context(delta_context(spark, path))


def check_parking(parking: DataFrame) -> DataFrame:
    """Fail on missing columns, no rows, or unusable readings."""
    require_columns(
        parking, {"lot_name", "observed_at", "collected_at", "occupied_spaces", "total_spaces"}, "parking"
    )
    require_rows(parking, "the parking table is empty")
    enforce(violations(parking, parking_rules(), F.col("lot_name")))
    return parking


def check_passengers(passengers: DataFrame) -> DataFrame:
    require_columns(
        passengers, {"terminal", "direction", "target_hour", "fetched_at", "expected_passengers"}, "passengers"
    )
    enforce(violations(passengers, passenger_rules(), F.col("terminal")), vintage_conflicts(passengers))
    return passengers


def scan_parking(spark: SparkSession, dataset: str) -> DataFrame:
    """Checked parking readings of an exported dataset."""
    return check_parking(delta_parking(spark, f"{dataset}/parking.csv"))


def scan_passengers(spark: SparkSession, dataset: str) -> DataFrame:
    return check_passengers(delta_passengers(spark, f"{dataset}/passenger_forecasts.csv"))


def scan_predictions(spark: SparkSession, *paths: str) -> DataFrame:
    """Issued next-day predictions of any number of runs, checked once before scoring."""
    issued = spark.read.option("mergeSchema", True).parquet(*paths)
    require_rows(issued, "no predictions to score")
    wrong = ~F.col("target_definition").eqNullSafe(TARGET_DEFINITION)
    enforce(
        violations(issued, {"wrong target definition": wrong}, F.col("target_definition")),
        duplicate_violations(issued, ["issue_date", "lot_name", "target_hour"], "repeated lot and hour"),
    )
    return issued


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Ad-hoc SELECT on the operational database; pass ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` with ``dbtable`` for large tables."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    return (reader if "dbtable" in options else reader.option("query", query)).load()
