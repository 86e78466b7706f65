"""Collection: landed responses to checked rows in the store, as batches or as a stream.

Each job checks the whole landed input, keeps what is new or changed, numbers it after the store's cursor and
commits it in one step.  Input that breaks a rule raises and leaves the store as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelot.functions.time import kst_date
from tidelot.operators.quality import enforce, violations
from tidelot.operators.vintages import batch_shape_violations
from tidelot.session import materialize, scratch
from tidelot.sources import payloads
from tidelot.sources.scan import flatten_context
from tidelot.sources.store import (
    CURSORS, SCHEMAS, append_rows, insert_ignore, load_state, read_table, snapshots_to_store, vintages_to_store,
)

READING_KEY = ["source", "lot_name", "observed_at"]


def _cursor(spark: SparkSession, root: str, table: str) -> Column:
    return F.lit(load_state(spark, root).cursors.get(CURSORS[table], 0)).cast("bigint")


def _shaped(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(*[
        F.col(name).cast(kind).alias(name) for name, kind in (c.split(" ") for c in SCHEMAS[table].split(", "))
    ])


def _numbered(requests: DataFrame, after: Column) -> DataFrame:
    """``(request_id, number)`` in the order of the ids, without gaps, however many requests have landed.

    Requests are ranked inside ranges of their ids; only the sizes of the ranges, one row each, are added up in one task.
    """
    ranged = materialize(
        requests.select("request_id").distinct().repartitionByRange("request_id").withColumn("part", F.spark_partition_id()), "requests")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("request_id"))
    return ranged.withColumn("within", within).join(starts, "part").select(
        "request_id", (after + F.col("start") + F.col("within")).alias("number"))


def collect_readings(spark: SparkSession, root: str, pages: DataFrame, source: str = "api") -> int:
    """Store the readings of landed pages ``(request_id, page, payload, fetched_at)`` that are not stored yet."""
    with scratch(spark):
        enforce(payloads.page_violations(payloads.envelope(pages), allow_empty=False))
        items = payloads.normalize_parking(payloads.parse_parking_payload(pages))
        enforce(violations(items, {"unusable reading": ~F.col("is_valid")}, F.col("request_id").cast("string")))
        times = pages.groupBy("request_id").agg(F.max("fetched_at").alias("collected_at"))
        rows = items.join(times, "request_id").select(
            F.lit(source).alias("source"), "lot_name", "observed_at", "collected_at", "occupied_spaces", "total_spaces")
        stored = read_table(spark, root, "parking")
        fresh = insert_ignore(rows, stored, READING_KEY, ["collected_at", "occupied_spaces", "total_spaces"], "observed_at")
        # Ids rise by task and row; gaps between tasks do no harm, a fixed copy keeps them through retries.
        numbered = fresh.withColumn("id", _cursor(spark, root, "parking") + 1 + F.monotonically_increasing_id())
        return append_rows(spark, root, "parking", materialize(_shaped(numbered, "parking"), "readings"))


def collect_forecasts(spark: SparkSession, root: str, pages: DataFrame, phase: str, source: str = "api") -> int:
    """Store the batches of landed responses ``(request_id, page, payload, fetched_at, day_offset)`` worth keeping.

    A column ``run`` says which responses were asked for together, where a backlog of several runs has landed; responses of
    one run are of different days. Without it all of them are one run. Batches are numbered in the order of their requests.
    """
    with scratch(spark):
        items = payloads.parse_passenger_payload(pages)
        enforce(payloads.page_violations(payloads.envelope(pages), allow_empty=False))
        enforce(payloads.passenger_date_violations(items))
        rows = payloads.normalize_passenger(items)
        enforce(violations(rows, {"unusable forecast": ~F.col("is_valid")}, F.col("request_id").cast("string")))
        numbers = _numbered(pages, _cursor(spark, root, "passengers")).withColumnRenamed("number", "batch_id")
        batches = materialize(_shaped(rows.join(numbers, "request_id").withColumns({
            "source": F.lit(source), "phase": F.lit(phase), "changed_count": F.lit(None),
            "target_date": F.date_add(kst_date(F.col("fetched_at")), F.col("day_offset")),
        }), "passengers"), "forecasts")
        run = F.min("run").cast("string") if "run" in pages.columns else F.lit("1")
        run = pages.groupBy("request_id").agg(run.alias("run"))
        runs = run.join(numbers, "request_id").select("batch_id", "run")
        enforce(batch_shape_violations(batches.join(runs, "batch_id"), "run"))
        kept = vintages_to_store(batches, read_table(spark, root, "passengers"))
        return append_rows(spark, root, "passengers", kept)


def collect_snapshots(spark: SparkSession, root: str, snapshots: DataFrame) -> int:
    """Store flight snapshots, and calendars that changed, of ``(request_id, source, kind, fetched_at, scope, records)``."""
    with scratch(spark):
        numbers = _numbered(snapshots, _cursor(spark, root, "context")).withColumnRenamed("number", "id")
        incoming = materialize(_shaped(snapshots.join(numbers, "request_id"), "context"), "snapshots")
        headers, flights, holidays = flatten_context(incoming)
        enforce(payloads.flight_snapshot_violations(flights, headers.drop("direction")))
        enforce(payloads.holiday_snapshot_violations(holidays, headers))
        kept = snapshots_to_store(incoming, read_table(spark, root, "context"))
        return append_rows(spark, root, "context", kept, allow_replay=False)


def collect_into(spark: SparkSession, job: Callable[..., int], root: str, **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function of one of the jobs; a batch that runs again stores nothing twice."""

    def run(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            job(spark, root, batch, **options)

    return run
