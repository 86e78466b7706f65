"""Run outputs: immutable issued runs, job records, replaceable evaluations, pointers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidelot.sources.fs import exists, list_files, read_json, write_json


def write_run(spark: SparkSession, root: str, run: str, frames: dict[str, DataFrame], facts: dict[str, dict]) -> str:
    """Write one run's tables and JSON facts, ``manifest.json`` last.

    Tables refuse to overwrite, so a written run cannot change.
    """
    folder = f"{root}/{run}"
    for name, frame in frames.items():
        frame.write.mode("errorifexists").parquet(f"{folder}/{name}")
    for name in sorted(facts, key=lambda n: n == "manifest"):
        write_json(spark, f"{folder}/{name}.json", facts[name])
    return folder


def attempt_name(day: object) -> str:
    """A folder of its own for every attempt at a day, so that a failed one is in nobody's way."""
    return f"run-{day}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, run: str, **facts) -> None:
    """Point to the newest run."""
    write_json(spark, f"{root}/latest.json", {"run_dir": run, **facts})


def issue(spark: SparkSession, root: str, day: object, run: str) -> None:
    """Make a complete run the one of its day."""
    write_json(spark, f"{root}/issued/{day}.json", {"run_dir": run})


def issued_run(spark: SparkSession, root: str, day: object) -> str | None:
    """The run issued for a day."""
    path = f"{root}/issued/{day}.json"
    return read_json(spark, path)["run_dir"] if exists(spark, path) else None


def issued_runs(spark: SparkSession, root: str) -> dict[str, str]:
    """Issued runs by day; runs that were not completed are not among them."""
    days = [name.removesuffix(".json") for name in list_files(spark, f"{root}/issued", ".json")]
    return {day: read_json(spark, f"{root}/issued/{day}.json")["run_dir"] for day in days}


def record_job(spark: SparkSession, root: str, day: object, facts: dict) -> dict:
    """Keep what became of a daily job, whether issued, skipped or failed."""
    write_json(spark, f"{root}/jobs/{day}.json", facts)
    return facts


def run_fact(spark: SparkSession, root: str, run: str, name: str) -> dict | None:
    path = f"{root}/{run}/{name}.json"
    return read_json(spark, path) if exists(spark, path) else None


def write_evaluations(path: str, rows: DataFrame) -> None:
    """Replace the issue dates in ``rows`` of an evaluation table; other dates stay."""
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("issue_date").parquet(path)
    )
