"""Structured Streaming over the append feed of readings."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidelot.functions.lots import occupancy_ratio
from tidelot.functions.time import from_instant, instant, to_instant, with_floor
from tidelot.operators.truth import MINIMUM_SLOTS, hourly_truth
from tidelot.session import materialize, scratch
from tidelot.sources.fs import exists, list_files, read_json, write_json
from tidelot.sources.store import append_epoch

LATENESS = "3 hours 1 minute"


def read_files(spark: SparkSession, path: str, schema: str, glob: str = "*.parquet") -> DataFrame:
    """A file stream of landed readings."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(path)


def _timed(readings: DataFrame, lateness: str) -> DataFrame:
    """Watermarks need an instant, so the UTC reading time is carried as one."""
    return readings.withColumn("event_time", to_instant(F.col("observed_at"))).withWatermark("event_time", lateness)


READING = ["source", "lot_name", "observed_at"]


def _first_known(timed: DataFrame) -> DataFrame:
    """One row per reading, the first collected; emitted once the watermark has passed its time."""
    rest = ["collected_at", "id", *[c for c in timed.columns if c not in {*READING, "collected_at", "id", "event_time"}]]
    first = timed.groupBy("event_time", *READING).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select("event_time", *READING, "_first.*")


def stream_dedup(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The first collected reading per source, lot and time, whatever the order of arrival.

    A reading comes out when the watermark has passed its time, for only then no
    earlier collected copy can follow; its state is dropped at the same moment.
    """
    return _first_known(_timed(readings, lateness)).select(*readings.columns)


def stream_hourly_truth(readings: DataFrame, lateness: str = LATENESS, minimum_slots: int = MINIMUM_SLOTS) -> DataFrame:
    """Truth of each lot-hour, emitted once the watermark passes its end.

    Copies are removed first, as in ``stream_dedup``.  State is one row per reading
    within the lateness and one row of partial aggregates per open lot-hour.
    Hours still open when a stream ends are left to the batch recomputation, and so are readings later than the
    watermark: ``watch_late`` keeps and counts them, ``repaired_truth`` recomputes their hours.
    """
    timed = _first_known(_timed(readings.where("total_spaces > 0"), lateness))
    ratio = occupancy_ratio(F.col("occupied_spaces"), F.col("total_spaces"))
    bit = F.expr("shiftleft(1, cast(minute(observed_at) div 10 as int))")
    grouped = timed.groupBy(F.window("event_time", "1 hour").alias("w"), "lot_name").agg(
        F.avg(ratio).alias("_mean"), F.max(ratio).alias("_max"), F.min(ratio).alias("_min"),
        F.bit_count(F.bit_or(bit)).cast("int").alias("observation_slots"),
        F.max("collected_at").alias("label_available_at"),
    )
    complete = F.col("observation_slots") >= minimum_slots
    return grouped.select(
        "lot_name", from_instant(F.col("w.start")).alias("target_hour"),
        F.when(complete, F.col("_mean")).alias("actual_ratio"),
        F.when(complete, F.col("_max")).alias("actual_max_ratio"),
        F.when(complete, F.col("_min")).alias("actual_min_ratio"),
        "observation_slots", "label_available_at",
    )


def drain_to_parquet(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything available and stop; restarts continue from the checkpoint."""
    query: StreamingQuery = (
        stream.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def drain_batches(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand each micro-batch to an idempotent merge (``stream_ingest``)."""
    query = (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def watch_late(spark: SparkSession, out: str, lateness: str = LATENESS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the readings behind the watermark, which the stream's own state drops.

    The watermark before an epoch is the latest reading time of all earlier epochs less the lateness, as the stream has
    it. An epoch writes its late readings and the time it has seen under its number, over what an earlier attempt wrote, so a
    replay changes nothing.
    """
    def watch(batch: DataFrame, epoch: int) -> None:
        with scratch(spark):
            known = read_json(spark, f"{out}/seen/{epoch - 1:012d}.json") if epoch else {"latest": None, "late": 0}
            rows = materialize(batch, "batch")
            latest = rows.agg(F.max("observed_at")).first()[0]
            before = None if known["latest"] is None else datetime.fromisoformat(known["latest"])
            count = 0
            if before is not None:
                late = rows.where(F.col("observed_at") < instant(before) - F.expr(f"INTERVAL {lateness}"))
                late.write.mode("overwrite").parquet(f"{out}/late/epoch={epoch}")
                count = spark.read.schema(rows.schema).parquet(f"{out}/late/epoch={epoch}").count()
            times = [t for t in (before, latest) if t is not None]
            write_json(spark, f"{out}/seen/{epoch:012d}.json", {
                "latest": max(times).isoformat() if times else None, "late": known["late"] + count})

    return watch


def late_count(spark: SparkSession, out: str) -> int:
    """How many late readings there have been."""
    names = list_files(spark, f"{out}/seen", ".json")
    return read_json(spark, f"{out}/seen/{names[-1]}")["late"] if names else 0


def late_rows(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The late readings so far, with the epoch that brought them."""
    if not exists(spark, f"{out}/late"):
        return spark.createDataFrame([], schema).withColumn("epoch", F.lit(0).cast("bigint"))
    rows = spark.read.schema(schema).option("basePath", f"{out}/late").parquet(f"{out}/late/*")
    return rows.withColumn("epoch", F.regexp_extract(F.input_file_name(), r"epoch=(\d+)", 1).cast("bigint"))


def repaired_truth(late: DataFrame, readings: DataFrame, minimum_slots: int = MINIMUM_SLOTS) -> DataFrame:
    """The truth of the lot-hours of late readings from the batch path, which reads these hours of ``readings`` only."""
    hours = with_floor(late, "observed_at", "target_hour", "1 hour").groupBy("lot_name", "target_hour").agg(
        F.count("*").alias("late_rows"), F.max("epoch").alias("last_epoch"))
    low, high = hours.agg(F.min("target_hour"), F.max("target_hour")).first()
    if low is not None:
        readings = readings.where((F.col("observed_at") >= instant(low)) & (F.col("observed_at") < instant(high + timedelta(hours=1))))
    again = with_floor(readings, "observed_at", "target_hour", "1 hour").join(hours, ["lot_name", "target_hour"], "left_semi")
    truth = hourly_truth(again.drop("target_hour"), minimum_slots=minimum_slots).drop("label_available_at")
    return hours.join(truth, ["lot_name", "target_hour"], "left")


QUERY_ID = "sql.streaming.queryId"


def ingest_into(spark: SparkSession, root: str, table: str, stream: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` merge into the store, exactly once an epoch.

    The epoch is committed together with its rows under the id of the streaming query, which its checkpoint keeps; an epoch that
    runs again after a failure finds itself in the store and does nothing. A new checkpoint is a new query, and what it reads
    again adds nothing, for rows are compared by key. A changed row fails the stream. ``stream`` names it where no query runs.
    """
    def merge(batch: DataFrame, epoch: int) -> None:
        name = stream or batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if name is None:
            raise ValueError("an epoch needs a streaming query or the name of a stream")
        append_epoch(spark, root, table, batch, name, epoch)

    return merge
