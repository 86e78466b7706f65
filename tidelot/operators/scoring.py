"""Forecast metrics, groups, evaluation status and model choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.functions.time import span, to_kst
from tidelot.operators.context import AVAILABILITY

# The busy limit, the statistics and their columns.
BUSY = 0.9
STATISTICS = ("mean", "max", "min")
ACTUAL = dict(zip(STATISTICS, ("actual_ratio", "actual_max_ratio", "actual_min_ratio")))
PREDICTED = dict(zip(STATISTICS, ("predicted_ratio", "predicted_max_ratio", "predicted_min_ratio")))
TARGET_DEFINITION = "hourly_mean_max_min_ratio"
CONTEXT_GROUPS = [
    "is_holiday", "is_day_off", "flight_arrival_available", "flight_departure_available", "context_used_by_model",
]


def metric_columns(actual: Column, predicted: Column, busy_threshold: float = BUSY) -> list[Column]:
    """Error and busy-hour aggregates; one pass, all map-side combinable."""
    busy, called = actual >= busy_threshold, predicted >= busy_threshold
    hits, misses = F.count_if(busy & called), F.count_if(busy != called)
    f1 = F.coalesce(F.try_divide(hits * 2.0, hits * 2.0 + misses), F.lit(0.0))
    return [
        F.count("*").alias("rows"),
        (F.avg(F.abs(actual - predicted)) * 100).alias("mae_percentage_points"),
        (F.sqrt(F.avg((actual - predicted) * (actual - predicted))) * 100).alias("rmse_percentage_points"),
        f1.alias("busy_f1"),
        F.count_if(busy).alias("actual_busy_rows"),
        F.lit(busy_threshold * 100).alias("busy_threshold_pct"),
    ]


def forecast_metrics(
    df: DataFrame, actual: str, predicted: str, keys: list[str] | None = None, busy_threshold: float = BUSY
) -> DataFrame:
    return df.groupBy(*(keys or [])).agg(*metric_columns(F.col(actual), F.col(predicted), busy_threshold))


def candidate_metrics(
    df: DataFrame, actual: str, models: list[str], keys: list[str], busy_threshold: float = BUSY
) -> DataFrame:
    """Metrics of every candidate; a model's forecast is in the column of its name."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("predicted")) for m in models])
    long = df.select(*keys, F.col(actual).alias("actual"), F.explode(pairs).alias("_p"))
    return forecast_metrics(
        long.select(*keys, "actual", "_p.model", "_p.predicted"), "actual", "predicted", [*keys, "model"], busy_threshold
    )


def unpivot_statistics(df: DataFrame, predicted: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per statistic with its actual and predicted value."""
    names = predicted or PREDICTED
    pairs = F.array(*[
        F.struct(F.lit(s).alias("statistic"), F.col(ACTUAL[s]).alias("actual"), F.col(names[s]).alias("predicted"))
        for s in STATISTICS
    ])
    return df.select(*(keep or []), F.explode(pairs).alias("_s")).select(
        *(keep or []), "_s.statistic", "_s.actual", "_s.predicted"
    )


def statistic_metrics(
    df: DataFrame, predicted: dict[str, str] | None = None, busy_threshold: float = BUSY, keys: list[str] | None = None
) -> DataFrame:
    """Metrics of mean, max and min, per ``keys`` if given."""
    long = unpivot_statistics(df, predicted, keep=keys)
    return forecast_metrics(long, "actual", "predicted", [*(keys or []), "statistic"], busy_threshold)


def metrics_by_group(df: DataFrame, busy_threshold: float = BUSY, by: list[str] | None = None) -> DataFrame:
    """Metrics overall, per lot, per local hour and per context flag, in one aggregation.

    A null flag is its own group.  ``by`` adds columns to every group's key.
    """
    keys = by or []
    values = {"all": F.lit("all"), "lot": F.col("lot_name"), "hour": F.hour(to_kst(F.col("target_hour")))}
    values |= {c: F.col(c).cast("int") for c in CONTEXT_GROUPS if c in df.columns}
    groups = F.array(*[
        F.struct(F.lit(kind).alias("group_kind"), value.cast("string").alias("group_value"))
        for kind, value in values.items()
    ])
    tagged = df.withColumn("_g", groups)
    long = unpivot_statistics(tagged, keep=[*keys, "_g"]).select("*", F.explode("_g").alias("g"))
    return forecast_metrics(
        long.select(*keys, "statistic", "actual", "predicted", "g.group_kind", "g.group_value"),
        "actual", "predicted", [*keys, "group_kind", "group_value", "statistic"], busy_threshold,
    )


def status_hourly() -> Column:
    return F.when(F.col("actual_ratio").isNotNull(), "matched").otherwise("pending_or_missing_observation")


def status_nextday(as_of: Column) -> Column:
    return (
        F.when(F.col("target_hour") + span(hours=1) > as_of, "pending")
        .when(F.col("actual_ratio").isNotNull(), "matched")
        .otherwise("missing")
    )


def with_errors(df: DataFrame) -> DataFrame:
    """Absolute errors in percentage points; null without a label."""
    return df.withColumns({
        f"{s}_absolute_error_percentage_points": F.abs(F.col(PREDICTED[s]) - F.col(ACTUAL[s])) * 100
        for s in STATISTICS
    })


def evaluate_nextday(predictions: DataFrame, truth: DataFrame, as_of: Column) -> DataFrame:
    """Predictions with truth, status and errors."""
    checked = predictions.join(truth, ["lot_name", "target_hour"], "left")
    return with_errors(checked.withColumn("evaluation_status", status_nextday(as_of)))


def eval_summary_nextday(checked: DataFrame, as_of: Column) -> DataFrame:
    """Counts, coverage and finality of each issue, errors of forecast and persistence, and context coverage.

    Persistence and context are summed up where their columns are there.
    """
    is_status = {s: F.count_if(F.col("evaluation_status") == s) for s in ("matched", "pending", "missing")}
    errors = {}
    kinds = {"forecast": PREDICTED}
    if "current_ratio" in checked.columns:
        kinds["persistence"] = dict.fromkeys(STATISTICS, "current_ratio")
    for kind, names in kinds.items():
        for s in STATISTICS:
            error = F.when(F.col("evaluation_status") == "matched", F.col(ACTUAL[s]) - F.col(names[s]))
            errors[f"{kind}_{s}_mae_percentage_points"] = F.avg(F.abs(error)) * 100
            errors[f"{kind}_{s}_rmse_percentage_points"] = F.sqrt(F.avg(error * error)) * 100
    coverage = {f"{c}_rows": F.count_if(F.col(c) == 1) for c in AVAILABILITY if c in checked.columns}
    return checked.groupBy("issue_date", "target_date").agg(
        F.when(F.max("target_hour") + span(hours=1) > as_of, "partial").otherwise("final").alias("status"),
        F.count("*").alias("prediction_rows"),
        *[n.alias(f"{s}_rows") for s, n in is_status.items()],
        (is_status["matched"] / F.count("*") * 100).alias("coverage_pct"),
        *[value.alias(name) for name, value in {**errors, **coverage}.items()],
    )


def evaluate_hourly(labelled: DataFrame) -> DataFrame:
    error = F.abs(F.col("predicted_ratio") - F.col("actual_ratio")) * 100
    return labelled.withColumns({
        "evaluation_status": status_hourly(), "absolute_error_percentage_points": error,
    })


def eval_summary_hourly(checked: DataFrame, busy_threshold: float = BUSY) -> DataFrame:
    """Row counts with model and persistence metrics over the matched rows."""
    matched = F.col("evaluation_status") == "matched"
    scored = {}
    for prefix, column in (("forecast", "predicted_ratio"), ("baseline", "current_ratio")):
        actual = F.when(matched, F.col("actual_ratio"))
        error = actual - F.col(column)
        scored[f"{prefix}_mae_percentage_points"] = F.avg(F.abs(error)) * 100
        scored[f"{prefix}_rmse_percentage_points"] = F.sqrt(F.avg(error * error)) * 100
        busy, called = actual >= busy_threshold, F.col(column) >= busy_threshold
        hits, misses = F.count_if(busy & called), F.count_if(busy != called)
        scored[f"{prefix}_busy_f1"] = F.coalesce(F.try_divide(hits * 2.0, hits * 2.0 + misses), F.lit(0.0))
    return checked.agg(
        F.count("*").alias("prediction_rows"),
        F.count_if(matched).alias("matched_rows"),
        F.count_if(~matched).alias("pending_or_missing_rows"),
        F.count_if(matched & (F.col("actual_ratio") >= busy_threshold)).alias("actual_busy_rows"),
        F.lit(busy_threshold * 100).alias("busy_threshold_pct"),
        *[value.alias(name) for name, value in scored.items()],
    )


def improvement_pct(baseline: Column, selected: Column) -> Column:
    """Relative gain over the baseline; negative when worse, 0 without an error to beat."""
    return F.when(baseline > 0, (baseline - selected) / baseline * 100).otherwise(0.0)


def argmin_model(errors: DataFrame, order: list[str], error: str = "error") -> DataFrame:
    """The model with the least error; ties go to the earlier name in ``order``."""
    rank = F.array_position(F.array(*[F.lit(name) for name in order]), F.col("model"))
    return errors.agg(F.min_by(F.col("model"), F.struct(F.col(error), rank)).alias("selected_model"))


def backtest_hourly_mean(results: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each column per local hour bucket of the origin."""
    local = results.select(F.window(to_kst(F.col("origin_at")), "1 hour").start.alias("hour"), *columns)
    return local.groupBy("hour").agg(*[F.avg(c).alias(c) for c in columns])


def forecast_feature_coverage(records: DataFrame) -> DataFrame:
    known = F.col("passengers_target_arrival").isNotNull().cast("double")
    return records.agg((F.avg(known) * 100).alias("forecast_feature_coverage_pct"))


def context_complete_days(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Days on which every row had all three kinds of context."""
    flags = [F.coalesce(F.col(c) == 1, F.lit(False)) for c in (
        "holiday_available", "flight_arrival_available", "flight_departure_available")]
    per_day = frame.groupBy(*keys, "target_date").agg(F.bool_and(flags[0] & flags[1] & flags[2]).alias("_all"))
    return per_day.groupBy(*keys).agg(F.count_if("_all").alias("context_complete_days"))
