"""Baselines and the output columns of issued forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.functions.lots import clamp_non_negative, whole_spaces
from tidelot.functions.time import minutes_between
from tidelot.operators.scoring import BUSY, PREDICTED, STATISTICS, TARGET_DEFINITION

STALE_MINUTES = 20

# History columns behind each statistic, week before day.
SEASONAL = {
    "mean": ("previous_week_same_hour", "previous_day_same_hour"),
    "max": ("previous_week_max", "previous_day_max"),
    "min": ("previous_week_min", "previous_day_min"),
}


def persistence() -> dict[str, Column]:
    return {s: F.col("current_ratio") for s in STATISTICS}


def seasonal() -> dict[str, Column]:
    return {s: F.coalesce(F.col(week), F.col(day), F.col("current_ratio")) for s, (week, day) in SEASONAL.items()}


def learned(columns: dict[str, str]) -> dict[str, Column]:
    return {s: clamp_non_negative(F.col(columns[s])) for s in STATISTICS}


def ordered(values: dict[str, Column]) -> dict[str, Column]:
    """Raise max to at least, and lower min to at most, the mean."""
    return {
        "mean": values["mean"],
        "max": F.greatest(values["max"], values["mean"]),
        "min": F.least(values["min"], values["mean"]),
    }


def with_forecast(df: DataFrame, values: dict[str, Column], names: dict[str, str] | None = None) -> DataFrame:
    """Add ordered mean, max and min forecasts under ``names``."""
    targets = names or PREDICTED
    return df.withColumns({targets[s]: value for s, value in ordered(values).items()})


def nextday_outputs(df: DataFrame, model: str, *, is_learned: bool, generated_at: Column) -> DataFrame:
    """Columns of an issued next-day forecast; the busy limit is fixed here."""
    return df.withColumns({
        "predicted_max_occupancy_pct": F.col("predicted_max_ratio") * 100,
        "predicted_min_occupancy_pct": F.col("predicted_min_ratio") * 100,
        "predicted_occupancy_pct": F.col("predicted_ratio") * 100,
        "estimated_occupied_spaces": whole_spaces(F.col("predicted_ratio"), F.col("current_capacity")),
        "predicted_busy": F.col("predicted_ratio") >= BUSY,
        "predicted_max_busy": F.col("predicted_max_ratio") >= BUSY,
        "model": F.lit(model),
        "prediction_kind": F.lit("learned" if is_learned else "baseline"),
        "context_used_by_model": F.lit(is_learned and model.endswith("_context")),
        "generated_at": generated_at,
        "target_definition": F.lit(TARGET_DEFINITION),
    })


def hourly_outputs(df: DataFrame, model: str, as_of: Column, busy_threshold: float = BUSY) -> DataFrame:
    """Columns of an issued hourly forecast from ``predicted_ratio``."""
    return df.select(
        "lot_name", "origin_at", "observed_at", "requested_target_at", "total_spaces", "current_ratio",
        "predicted_ratio",
        (F.col("predicted_ratio") * 100).alias("predicted_occupancy_pct"),
        whole_spaces(F.col("predicted_ratio"), F.col("total_spaces")).alias("estimated_occupied_spaces"),
        (F.col("predicted_ratio") >= busy_threshold).alias("predicted_busy"),
        F.lit(model).alias("model"),
        F.lit("baseline" if model == "persistence" else "learned").alias("prediction_kind"),
        (minutes_between(F.col("origin_at"), as_of) > STALE_MINUTES).alias("stale_input"),
    )
