"""Duplicate and clock filters, quality reports and rule checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelot.functions.time import minutes_between
from tidelot.operators.asof import previous_in_time

GAP_LIMIT_MINUTES = 20


class DataQualityError(ValueError):
    """Input broke one or more rules; the message lists them."""


def dedup_first(parking: DataFrame, *, keys: tuple[str, ...] = ("lot_name", "observed_at")) -> DataFrame:
    """Keep the first collected reading of each lot and time.

    A ``row_number() = 1`` filter lets Spark limit each group before the shuffle,
    so a large group of copies leaves one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy("collected_at", "id")
    return parking.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def filter_clock_order(parking: DataFrame) -> DataFrame:
    """Drop readings observed after they were collected."""
    return parking.where("observed_at <= collected_at")


def clean_parking(parking: DataFrame) -> DataFrame:
    """Deduplicate first, then drop clock errors."""
    return filter_clock_order(dedup_first(parking))


def filter_operating(parking: DataFrame) -> DataFrame:
    return parking.where("total_spaces > 0")


def visible_as_of(parking: DataFrame, at: Column) -> DataFrame:
    """Rows both observed and collected by ``at``."""
    return parking.where((F.col("collected_at") <= at) & (F.col("observed_at") <= at))


def duplicate_and_clock_counts(parking: DataFrame) -> DataFrame:
    """Duplicates removed and clock errors among the kept rows, in one row."""
    per_reading = parking.groupBy("lot_name", "observed_at").agg(
        F.count("*").alias("copies"), F.min("collected_at").alias("collected_at")
    )
    return per_reading.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows_removed"),
        F.count_if(F.col("observed_at") > F.col("collected_at")).alias("invalid_clock_rows_excluded"),
    )


def gap_minutes(parking: DataFrame) -> DataFrame:
    """Minutes since the lot's previous reading; null for its first."""
    lagged = previous_in_time(parking, keys=["lot_name"], time="observed_at", name="_previous")
    return lagged.withColumn(
        "gap_minutes", minutes_between(F.col("_previous"), F.col("observed_at"))
    ).drop("_previous")


def quality_per_lot(parking: DataFrame) -> DataFrame:
    """Coverage, gaps and capacity facts of each lot."""
    operating = F.col("total_spaces") > 0
    return gap_minutes(parking).groupBy("lot_name").agg(
        F.count("*").alias("rows"),
        F.min("observed_at").alias("first_observed_at"),
        F.max("observed_at").alias("last_observed_at"),
        F.count_if(F.col("gap_minutes") > GAP_LIMIT_MINUTES).alias("gaps_over_20_minutes"),
        F.max("gap_minutes").alias("max_gap_minutes"),
        F.count_distinct("total_spaces").alias("capacity_versions"),
        F.count_if(F.col("total_spaces") == 0).alias("inactive_rows"),
        F.count_if(operating & (F.col("occupied_spaces") > F.col("total_spaces"))).alias("over_capacity_rows"),
    )


def quality_global(parking: DataFrame) -> DataFrame:
    return parking.agg(
        F.count("*").alias("parking_rows"),
        F.count_distinct("lot_name").alias("lots"),
        F.min("observed_at").alias("first_observed_at"),
        F.max("observed_at").alias("last_observed_at"),
        (minutes_between(F.min("observed_at"), F.max("observed_at")) / 1440).alias("span_days"),
    )


def violations(df: DataFrame, rules: dict[str, Column], key: Column) -> DataFrame:
    """Broken rules with row counts and an example key, in one scan.

    ``rules`` maps a name to a condition that is true for an offending row.
    """
    hits = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return (
        df.select(F.explode(hits).alias("rule"), key.cast("string").alias("key"))
        .groupBy("rule")
        .agg(F.count("*").alias("n"), F.min("key").alias("key"))
    )


def duplicate_violations(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Keys that occur more than once, as one violation row."""
    shown = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (
        df.groupBy(*keys).agg(F.count("*").alias("_c")).where("_c > 1")
        .agg(F.sum("_c").alias("n"), F.min(shown).alias("key"))
        .where("n > 0")
        .select(F.lit(rule).alias("rule"), "n", "key")
    )


def enforce(*found: DataFrame) -> None:
    """Raise when any violation frame has rows (one row per rule, so bounded)."""
    broken = [row for frame in found for row in frame.collect()]
    if broken:
        raise DataQualityError("; ".join(f"{r['rule']}: {r['n']} rows, e.g. {r['key']}" for r in broken))


def require_columns(df: DataFrame, columns: set[str], what: str) -> None:
    missing = columns - set(df.columns)
    if missing:
        raise DataQualityError(f"{what} lacks columns: {sorted(missing)}")


def require_rows(df: DataFrame, message: str) -> None:
    if df.isEmpty():
        raise DataQualityError(message)


def parking_rules() -> dict[str, Column]:
    """Conditions that make a typed reading unusable."""
    return {
        "missing lot name": F.col("lot_name").isNull() | (F.trim("lot_name") == ""),
        "missing reading time": F.col("observed_at").isNull() | F.col("collected_at").isNull(),
        "bad occupied count": F.coalesce(F.col("occupied_spaces") < 0, F.lit(True)),
        "bad total count": F.coalesce(F.col("total_spaces") < 0, F.lit(True)),
    }


def passenger_rules() -> dict[str, Column]:
    return {
        "missing forecast time": F.col("target_hour").isNull() | F.col("fetched_at").isNull(),
        "unknown terminal": ~F.coalesce(F.col("terminal").isin("T1", "T2"), F.lit(False)),
        "unknown direction": ~F.coalesce(F.col("direction").isin("arrival", "departure"), F.lit(False)),
        "bad passenger count": F.coalesce(F.col("expected_passengers") < 0, F.lit(True)),
    }
