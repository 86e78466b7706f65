"""The summary of stored readings, kept beside the store and named by its state.

A refresh sums up the lot-hours that batches since the last one touch, and writes the UTC days of these hours anew, each
refresh into a folder of its own; the state says which folder holds a day. A reader opens the days it asks for.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelot.functions.time import DEFAULT_CUTOFF, instant
from tidelot.operators.summaries import HOUR, summary_of_hours, touched_hours
from tidelot.session import materialize, scratch
from tidelot.sources.fs import exists, read_json, remove
from tidelot.sources.store import StoreChanged, StoreState, commit, load_state, read_batches

SUMMARY = (
    "lot_name string, target_hour timestamp_ntz, known_from date, readings bigint, ratio_sum double, ratio_max double, "
    "ratio_min double, slots int, available_at timestamp_ntz, "
    "latest struct<collected_at: timestamp_ntz, observed_at: timestamp_ntz, occupied_spaces: int, total_spaces: int>"
)


def read_summary(
    spark: SparkSession, root: str, state: StoreState, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Summary rows of all summarised UTC days, or of those from ``first`` to ``last``."""
    low, high = str(first or date.min), str(last or date.max)
    paths = [f"{root}/summary/{folder}/target_day={day}" for day, folder in state.summary_days.items() if low <= day <= high]
    return spark.read.schema(SUMMARY).parquet(*paths) if paths else spark.createDataFrame([], SUMMARY)


def refresh_summary(spark: SparkSession, root: str, cutoff_time: str = DEFAULT_CUTOFF) -> int:
    """Bring the summary up to date with the store; returns how many days were written. Another cutoff begins anew."""
    before = load_state(spark, root)
    start = before if before.summary_cutoff == cutoff_time else replace(before, summarised=[], summary_days={})
    landed = [name for name in before.batches["parking"] if name not in start.summarised]
    if not landed:
        return 0
    folder = f"summary-{uuid.uuid4().hex}"
    with scratch(spark):
        delta = read_batches(spark, root, "parking", landed)
        hours = materialize(touched_hours(delta), "hours")
        low, high = hours.agg(F.min("target_hour"), F.max("target_hour")).first()
        if low is None:
            return 0
        seen = F.col("observed_at")
        stored = read_batches(spark, root, "parking", [n for n in before.batches["parking"] if n in start.summarised]).where(
            (seen >= instant(low)) & (seen < instant(high + timedelta(hours=1))))
        days = [str(r["d"]) for r in hours.select(F.to_date("target_hour").alias("d")).distinct().collect()]
        written = replace(start, summary_days={d: f for d, f in start.summary_days.items() if d in days})
        kept = read_summary(spark, root, written).join(hours, HOUR, "left_anti")
        rows = kept.unionByName(summary_of_hours(stored, delta, hours, cutoff_time)).withColumn("target_day", F.to_date("target_hour"))
        rows.repartition("target_day").write.partitionBy("target_day").parquet(f"{root}/summary/{folder}")
    found = {str(r["target_day"]) for r in spark.read.parquet(f"{root}/summary/{folder}").select("target_day").distinct().collect()}
    after = replace(
        start, summarised=list(before.batches["parking"]), summary_cutoff=cutoff_time,
        summary_days={d: f for d, f in start.summary_days.items() if d not in days} | {d: folder for d in sorted(found)})
    try:
        commit(spark, root, before, after)
    except StoreChanged:
        remove(spark, f"{root}/summary/{folder}")
        raise
    return len(found)


def dataset_summary(spark: SparkSession, folder: str, cutoff_time: str) -> DataFrame | None:
    """The summary that a dataset names, where it covers all of its readings and was made for this cutoff."""
    path = f"{folder}/manifest.json"
    manifest = read_json(spark, path) if exists(spark, path) else {}
    if manifest.get("kind") != "batches" or manifest.get("summary_cutoff") != cutoff_time:
        return None
    if not set(manifest["batches"]["parking"]) <= set(manifest["summarised"]):
        return None
    root = folder.rstrip("/").rsplit("/", 2)[0]
    return read_summary(spark, root, StoreState(summary_days=manifest["summary_days"]))
