"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target number of words. Complete epochs of a source come first; the rest of its target is a sample
without replacement: each document draws an exponential key scaled by its quality weight, keys are sorted within the
source and sizes are summed up to the budget. The document that crosses the budget is taken where that comes nearer.

The sort is never one task a source: keys fall into ordered buckets, sums of buckets are cumulated, and rows are
sorted inside a bucket only.

Defined results: a null text has size zero; a null source is a source of its own, last in order; documents of size
zero take no words; sources without words have target zero; equal keys go by id, then size; repeated rows are
separate documents; the draw depends on the id alone, so reruns agree. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelot.llm.common import text_of, word_count

SOURCE_WEIGHTS, MOST_EPOCHS = (5, 2, 1), 3
#: Rows of a bucket in expectation, and buckets of a source at least.
BUCKET_ROWS, LEAST_BUCKETS = 20_000, 64
SYMBOLS = "[#*$%&|<>]"


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: the share of words against words and symbol characters."""
    return (size + 1) / (size + 1 + F.regexp_count(text, F.lit(SYMBOLS)))


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """Exponential with rate ``weight``; the uniform number is drawn from the id."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 48)) / weight


def targets(sizes: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """``sizes (source, source_size)`` with ``target``: all words shared by weight, none above ``most`` times its source.

    With caps, every target is min(cap, level * weight). Sources are filled in the order of cap / weight, and the level
    is the first at which the words left are shared without reaching the next cap. The rows are the sources.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    place = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    caps = sizes.withColumn("weight", place.cast("double")).withColumn("cap", F.col("source_size") * float(most))
    rate = caps.withColumn("rate", F.col("cap") / F.col("weight"))
    filled = Window.orderBy("rate", F.col("source").isNull(), "source")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "weight").over(after)
    levels = rate.withColumn("level", level)
    reached = F.min(F.when(F.col("level") <= F.col("rate") * (1 + 1e-12), F.struct("rate", "level"))).over(everything)
    return levels.withColumn("level", reached["level"]).select(
        "source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def sized(docs: DataFrame, keep: list[str], text: str = "text", doc_id: str = "doc_id", source: str = "source",
          prefix: str = "__mix_") -> DataFrame:
    """``keep`` with the id, source, size and sampling key of each document in columns named with ``prefix``."""
    size = word_count(text_of(text))
    return docs.select(*keep, F.col(doc_id).alias(f"{prefix}id"), F.col(source).cast("string").alias(f"{prefix}source"),
                       size.alias(f"{prefix}size"),
                       sampling_key(F.col(doc_id), quality_weight(text_of(text), size)).alias(f"{prefix}key"))


def mix(rows: DataFrame, n_rows: int, weights: tuple[int, ...] = SOURCE_WEIGHTS, most: float = MOST_EPOCHS,
        prefix: str = "__mix_") -> DataFrame:
    """:func:`sized` rows with ``source_size``, ``target``, ``copies`` and ``taken``, named with ``prefix``.

    Whole rows are dealt once, by whether there is a source, source and bucket: both the sums inside a bucket and the
    lookup of its state use that.
    """
    c = lambda name: F.col(prefix + name)
    buckets = max(LEAST_BUCKETS, -(-n_rows // BUCKET_ROWS))
    dealt = rows.withColumn(f"{prefix}bucket", F.least(
        F.floor((1 - F.exp(-c("key"))) * buckets), F.lit(buckets - 1)).cast("int")).withColumns({
            f"{prefix}none": c("source").isNull(), f"{prefix}named": F.coalesce(c("source"), F.lit(""))})
    place = [f"{prefix}{name}" for name in ("none", "named", "bucket")]
    sums = dealt.groupBy(c("source").alias("source"), c("bucket").alias("bucket")).agg(F.sum(c("size")).alias("words"))
    shares = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    state = (
        sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(shares, sums["source"].eqNullSafe(shares["source"])).drop(shares["source"])
        .select(F.col("source").isNull().alias(place[0]), F.coalesce("source", F.lit("")).alias(place[1]),
                F.col("bucket").alias(place[2]), F.col("before").alias(f"{prefix}before"),
                F.col("source_size").alias(f"{prefix}source_size"), F.col("target").alias(f"{prefix}target"))
    )
    inside = Window.partitionBy(*place).orderBy(c("key"), c("id"), c("size")).rowsBetween(Window.unboundedPreceding, -1)
    joined = dealt.withColumn(f"{prefix}inside", F.coalesce(F.sum(c("size")).over(inside), F.lit(0))).join(state, place)
    start = c("before") + c("inside")
    epochs = F.when(c("source_size") > 0, F.floor(c("target") / c("source_size"))).otherwise(F.lit(0))
    rest = c("target") - epochs * c("source_size")
    extra = F.when(c("source_size") > 0, (2 * start + c("size") <= 2 * rest).cast("long")).otherwise(F.lit(0))
    return (
        joined.withColumn(f"{prefix}copies", (epochs + extra).cast("long"))
        .withColumn(f"{prefix}taken", c("copies") * c("size")).drop(*place, f"{prefix}before", f"{prefix}inside")
    )
