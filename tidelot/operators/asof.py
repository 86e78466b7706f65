"""As-of and nearest lookups that stay linear under skew.

Spark's DataFrame API has no as-of join.  An equi-join on a time bucket followed
by ``max_by`` emits every pair inside a bucket, and a window over the whole key
puts a hot key into one task.  This form does neither:

1. queries and history are merged to one row per (keys, instant), with map-side
   combine, so copies of one instant collapse before the shuffle;
2. a per-bucket summary is carried across buckets, one row per (keys, bucket);
3. what is carried is joined to the instants of buckets that hold a query, and a
   window over (keys, bucket) answers them, falling back to the carried value;
4. a bucket of more than :data:`DENSE` instants is split once more, by the square
   root of its width, and answered in the same way inside the bucket.

A window group therefore holds at most :data:`DENSE` instants or the square root of the
bucket's microseconds (35 thousand for twenty minutes), however dense a key is;
the carry window over a key holds one row per bucket, which the time span
bounds.  Lookback is not limited.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelot.functions.time import EPOCH

#: Instants that a bucket may hold before it is split.
DENSE = 8192
_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


@dataclass(frozen=True)
class Channel:
    """Columns carried together; a history row counts if ``present`` is set."""

    name: str
    present: str
    columns: tuple[str, ...]


def _pack(channel: Channel):
    fields = F.struct(*[F.col(f"_{channel.name}_{c}").alias(c) for c in channel.columns])
    return F.when(F.col(f"_{channel.name}_at").isNotNull(), fields).alias(channel.name)


def asof_events(history: DataFrame, channels: list[Channel], keys: list[str], at, tie, tag=None) -> DataFrame:
    """Rows in the shape ``answer_events`` takes; ``tag`` 0 marks history."""
    return history.select(
        *keys, at.alias("_t"), (F.lit(0) if tag is None else tag).cast("int").alias("_tag"), tie.alias("_tie"),
        *[F.col(c).alias(f"_v_{c}") for c in _carried(channels)],
    )


def _carried(channels: list[Channel]) -> list[str]:
    return sorted({c for ch in channels for c in ch.columns} | {ch.present for ch in channels})


def asof_lookup(
    queries: DataFrame,
    history: DataFrame,
    *,
    keys: list[str],
    query_time: str,
    history_time: str,
    tie: str,
    channels: list[Channel],
    tag: str | None = None,
    bucket: str | None = "20 minutes",
    following: bool = False,
) -> DataFrame:
    """Answer each distinct (keys, query time) with the last history row at or before it.

    Returns ``keys``, ``at``, ``tag`` (bitwise or of the queries' tags) and one
    struct per channel.  Among history rows of one instant the largest ``tie``
    wins.  ``bucket=None`` is for keys that hold a time bucket themselves; the window
    then runs over the keys alone.  With ``following`` a struct ``next_<channel>`` holds the first history
    row strictly after the query time as well.
    """
    past = asof_events(history, channels, keys, F.col(history_time), F.col(tie))
    asked = queries.select(
        *keys, F.col(query_time).alias("_t"), (F.col(tag) if tag else F.lit(1)).cast("int").alias("_tag"),
    )
    events = past.unionByName(asked, allowMissingColumns=True)
    return answer_events(events, keys=keys, channels=channels, bucket=bucket, following=following)


def answer_events(
    events: DataFrame,
    *,
    keys: list[str],
    channels: list[Channel],
    bucket: str | None = "20 minutes",
    following: bool = False,
) -> DataFrame:
    """``asof_lookup`` on history and query rows that are already in one frame."""

    def value_at(channel: Channel, column: str):
        seen = F.when(F.col(f"_v_{channel.present}").isNotNull(), F.col("_tie"))
        return F.max_by(f"_v_{column}", seen).alias(f"_{channel.name}_{column}")

    def seen_at(channel: Channel):
        seen = F.when(F.col(f"_v_{channel.present}").isNotNull(), F.col("_t"))
        return F.max(seen).alias(f"_{channel.name}_at")

    # Both uses below list the aggregates in this order, so they share one shuffle.
    merged = events.groupBy(*keys, "_t").agg(
        F.bit_or("_tag").alias("_tag"),
        *[c for ch in channels for c in (seen_at(ch), *[value_at(ch, v) for v in ch.columns])],
    )
    if bucket is None:
        return _answers(merged, keys, keys, channels, following)
    width = width_micros(bucket)
    merged = merged.where("_t is not null")  # A row without a time lies in no bucket.
    loose, dense = by_density(_bucketed(merged, keys, "_bucket", width, channels, following))
    within = _bucketed(dense, [*keys, "_bucket"], "_part", isqrt(width), channels, following)
    return _answers(loose, keys, [*keys, "_bucket"], channels, following).unionByName(
        _answers(within, keys, [*keys, "_bucket", "_part"], channels, following))


def width_micros(width: str) -> int:
    """``20 minutes`` in microseconds."""
    count, unit = width.split()
    return int(count) * _MICROS[unit.removesuffix("s")]


def bucket_number(time: str, width: int) -> Column:
    """Number of the bucket of ``width`` microseconds that a time lies in."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(time))
    return F.floor(micros / F.lit(width)) if width > 1 else micros


def by_density(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of buckets that are answered as they are, and those of buckets to split; ``_n`` counts a row's bucket."""
    return rows.where(F.col("_n") <= DENSE).drop("_n"), rows.where(F.col("_n") > DENSE).drop("_n")


def _bucketed(
    rows: DataFrame, group: list[str], name: str, width: int, channels: list[Channel], following: bool
) -> DataFrame:
    """Instants of the buckets of each group that hold a query, with ``_n`` and what is carried into their bucket."""
    # Never null: else Spark puts a null check of each join's bucket below the merge, and no two uses of it share a shuffle.
    rows = rows.withColumn(name, F.coalesce(bucket_number("_t", width), F.lit(0)))

    def edge(channel: Channel, pick, prefix: str):
        at = F.col(f"_{channel.name}_at")
        return [
            *[pick(f"_{channel.name}_{c}", at).alias(f"{prefix}_{channel.name}_{c}") for c in channel.columns],
            (F.max if pick is F.max_by else F.min)(at).alias(f"{prefix}_{channel.name}_at"),
        ]

    edges = [col for ch in channels for col in edge(ch, F.max_by, "l")]
    if following:
        edges += [col for ch in channels for col in edge(ch, F.min_by, "f")]
    per_bucket = rows.groupBy(*group, name).agg(F.count("*").alias("_n"), F.bit_or("_tag").alias("_asked"), *edges)

    def packed_edge(channel: Channel, prefix: str):
        fields = F.struct(*[F.col(f"{prefix}_{channel.name}_{c}").alias(c) for c in channel.columns])
        return F.when(F.col(f"{prefix}_{channel.name}_at").isNotNull(), fields)

    # Spark recomputes a frame that ends at UNBOUNDED FOLLOWING for every row, so
    # "next" is taken as "last" over the reversed order, which grows row by row.
    before = Window.partitionBy(*group).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*group).orderBy(F.desc(name)).rowsBetween(Window.unboundedPreceding, -1)
    sides = [("c", "l", before), ("n", "f", after)] if following else [("c", "l", before)]
    carry = per_bucket.select(*group, name, "_n", "_asked", *[
        F.last(packed_edge(ch, prefix), ignorenulls=True).over(order).alias(f"_new_{side}_{ch.name}")
        for ch in channels for side, prefix, order in sides
    ]).where("_asked > 0").drop("_asked")
    joined = rows.join(carry, [*group, name])
    # What comes from inside a split bucket is nearer than what was carried into the whole of it.
    known = {f"_{side}_{ch.name}": (F.coalesce(f"_new_{side}_{ch.name}", f"_{side}_{ch.name}")
                                    if f"_{side}_{ch.name}" in rows.columns else F.col(f"_new_{side}_{ch.name}"))
             for ch in channels for side, _, _ in sides}
    return joined.withColumns(known).drop(*[f"_new{c}" for c in known])


def _answers(
    rows: DataFrame,
    keys: list[str],
    group: list[str],
    channels: list[Channel],
    following: bool,
) -> DataFrame:
    """The last (and next) known channel values at every query row."""
    upto = Window.partitionBy(*group).orderBy("_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beyond = Window.partitionBy(*group).orderBy(F.desc("_t")).rowsBetween(Window.unboundedPreceding, -1)

    def known(channel: Channel, order, side: str, name: str):
        inside = F.last(_pack(channel), ignorenulls=True).over(order)
        carried = f"_{side}_{channel.name}"
        return (F.coalesce(inside, carried) if carried in rows.columns else inside).alias(name)

    found = [known(ch, upto, "c", ch.name) for ch in channels]
    if following:
        found += [known(ch, beyond, "n", f"next_{ch.name}") for ch in channels]
    return rows.select(*keys, F.col("_t").alias("at"), F.col("_tag").alias("tag"), *found).where("tag > 0")


def previous_in_time(df: DataFrame, *, keys: list[str], time: str, name: str, bucket: str = "1 hour") -> DataFrame:
    """Add the preceding row's time within each key (``lag``), without one task per key.

    Dense buckets are split as in ``answer_events``, so a window group is bounded unless many rows share an instant.
    """
    width = width_micros(bucket)
    loose, dense = by_density(_preceded(df, keys, time, "_bucket", width))
    within = _preceded(dense, [*keys, "_bucket"], time, "_part", isqrt(width))

    def lagged(rows: DataFrame, group: list[str]) -> DataFrame:
        inside = F.lag(time).over(Window.partitionBy(*group).orderBy(time))
        return rows.withColumn(name, F.coalesce(inside, "_before")).select(*df.columns, name)

    return lagged(loose, [*keys, "_bucket"]).unionByName(lagged(within, [*keys, "_bucket", "_part"]))


def _preceded(rows: DataFrame, group: list[str], time: str, name: str, width: int) -> DataFrame:
    """Rows with ``_n``, how many their bucket has, and ``_before``, the last time before it."""
    bucketed = rows.withColumn(name, bucket_number(time, width))
    edges = bucketed.groupBy(*group, name).agg(F.max(time).alias("_edge"), F.count("*").alias("_n"))
    edges = edges.select(*group, name, "_n", F.lag("_edge").over(Window.partitionBy(*group).orderBy(name)).alias("_new_before"))
    joined = bucketed.join(edges, [*group, name])
    before = F.coalesce("_new_before", "_before") if "_before" in rows.columns else F.col("_new_before")
    return joined.withColumn("_before", before).drop("_new_before")
