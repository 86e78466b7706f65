"""Latest rows, top-n reports, key ranges and batch joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``; only one row per key and task is shuffled."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_per_lot(parking: DataFrame) -> DataFrame:
    return latest_by(parking, ["lot_name"], ["collected_at", "observed_at"])


def operating_lots(parking: DataFrame) -> DataFrame:
    """Lots whose latest reading shows them open."""
    return latest_per_lot(parking).where("total_spaces > 0").select("lot_name")


def latest_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def join_batches(forecasts: DataFrame, batches: DataFrame) -> DataFrame:
    """Forecast values with the header of their batch."""
    return forecasts.join(batches, "batch_id", "inner")


def delta_range_scan(df: DataFrame, cursor: str, lower: int, upper: int) -> DataFrame:
    """Rows after ``lower`` up to and including ``upper``."""
    return df.where((F.col(cursor) > lower) & (F.col(cursor) <= upper))


def max_cursor(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(cursor), F.lit(0)).cast("bigint").alias("max_cursor"))


def snapshot_inventory(headers: DataFrame, records: DataFrame) -> DataFrame:
    """Per kind: snapshots, last fetch and number of records."""
    sizes = records.groupBy("snapshot_id").agg(F.count("*").alias("records"))
    return (
        headers.join(sizes, headers.id == sizes.snapshot_id, "left")
        .groupBy("kind")
        .agg(
            F.count("*").alias("snapshots"),
            F.max("fetched_at").alias("last_fetched_at"),
            F.sum(F.coalesce("records", F.lit(0))).alias("records"),
        )
    )
