"""Exact top-k inner product by vector-approximation files.

Components count as floor(256 x). Equal vectors are one candidate that carries its few smallest ids. There is a file for each
vector length, which holds one byte a component: the cell between two of 257 borders, which are quantiles of the
component over all vectors, so that a few far values cost one cell. A scan of the cells, block of queries against block
of candidates, bounds every score from both sides; what cannot reach the k-th best lower bound goes. The rest are read exactly in the order
of their upper bounds, a slice of :data:`SLICE` a query first; what then could still reach the k-th best exact score is read too, and then
the result is certain.

Query blocks are sent to the file, at most :data:`SENT_BYTES` at a time, so candidates are neither copied nor shuffled for a scan. No
step gathers the candidates of a query in one task: slices and results are limited before they are shuffled, and
exact scores are computed pair by pair.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, neither as query nor as candidate;
a query meets the vectors of its own length; equal scores go to the smaller id; a query with fewer
candidates gets all; rows with a null id take no part; rows repeated whole count once, an id with several vectors is
several candidates, none of them a partner of its own id; as a query it asks with the least of each length. Ranks are those of the exact
integers, however large; a score beyond 64 bits is given as the nearest 64-bit integer. Ids are read as 64-bit integers. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelot.llm.common import saved, ship_package

CELLS, SCALE = 256, 256
#: Rows of a block of queries and of candidates; a scan holds one block of each.
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: Candidates of a query that are read exactly first, and bytes of queries that are sent to the files at a time.
SLICE, SENT_BYTES = 64, 32 << 20
RESULT = "query_id long, rank int, vec_id long, score long"


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, v, length)`` of the vectors that take part."""
    raw = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return raw.where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("length", F.size("v"))


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """``(rep, ids, v, length)``: each distinct vector with its ``keep`` smallest ids, of which ``rep`` is the first.

    An id with several vectors is the ``rep`` of several classes.
    """
    least = Window.partitionBy("v").orderBy("vec_id")
    ranked = vectors.withColumn("r", F.row_number().over(least)).where(F.col("r") <= keep)
    return ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("rep"), "ids", "v", F.size("v").alias("length"))


def grids(exact: DataFrame) -> DataFrame:
    """``(length, borders)``: 257 borders of each component of each length, one after the other; the outer ones are its ends."""
    shares = F.array(*[F.lit(i / CELLS) for i in range(1, CELLS)])
    ends = exact.select("length", F.posexplode("v").alias("d", "x")).groupBy("length", "d").agg(
        F.min("x").alias("a"), F.percentile_approx("x", shares, 10_000).alias("q"), F.max("x").alias("z"))
    return ends.select("length", "d", F.concat(F.array("a"), "q", F.array("z")).alias("b")).groupBy("length").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("d", "b"))), lambda s: s["b"])).alias("borders"))


def _whole(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as doubles; whole numbers, or infinite where 256 x is beyond a double."""
    with np.errstate(over="ignore"):
        return np.floor(np.asarray(x, np.float64) * SCALE)


def approximation_file(exact: DataFrame, borders: DataFrame, block: int) -> DataFrame:
    """``(length, classes, reps, alone, cells, borders)``: blocks of candidates with one byte a component.

    A class goes into a block of its length by hash.
    """
    sizes = exact.groupBy("length").agg((F.floor((F.count("*") - 1) / block) + 1).alias("blocks"))
    dealt = exact.join(sizes, "length").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    gathered = dealt.groupBy("length", "block").agg(
        F.collect_list("class").alias("classes"), F.collect_list("rep").alias("reps"), F.collect_list("alone").alias("alone"),
        F.flatten(F.collect_list("v")).alias("x")).join(borders, "length")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cells = []
            for length, x, edges in zip(frame["length"], frame["x"], frame["borders"], strict=True):
                x, edges = np.asarray(x).reshape(-1, length), np.asarray(edges).reshape(length, CELLS + 1)
                out = np.empty(x.shape, np.uint8)
                for d in range(length):
                    out[:, d] = np.clip(np.searchsorted(edges[d], x[:, d], "right") - 1, 0, CELLS - 1)
                cells.append(out.tobytes())
            yield frame.assign(cells=cells)[["length", "classes", "reps", "alone", "cells", "borders"]]

    return gathered.drop("block").mapInPandas(
        work, "length int, classes array<long>, reps array<long>, alone array<boolean>, cells binary, borders array<double>")


def bounds(queries: np.ndarray, cells: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores, a row a query; what rounding can add is added."""
    with np.errstate(over="ignore", invalid="ignore"):
        places = np.arange(edges.shape[0])
        low, high = _whole(edges[places, cells]), _whole(edges[places, cells.astype(np.int64) + 1])
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        upper, lower = up @ high.T + down @ low.T, up @ low.T + down @ high.T
        slack = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T * ((len(places) + 4) * 2.0 ** -51)
        upper, lower = upper + slack, lower - slack
    return np.where(np.isnan(lower), -np.inf, lower), np.where(np.isnan(upper), np.inf, upper)


def _scan(file: DataFrame, sent: Broadcast, k: int) -> DataFrame:
    """``(query_id, length, class, lower, upper)`` of what may be among a query's k best as far as one block of candidates tells.

    Classes that hold the query's own id alone are left out first, so that each class counts for one partner.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_length = sent.value
        for frame in frames:
            for length, ids, reps, alone, cells, edges in frame.itertuples(index=False, name=None):
                if length not in by_length:
                    continue
                asked, whole = by_length[length]
                ids, reps, alone = np.asarray(ids), np.asarray(reps), np.asarray(alone, bool)
                cells = np.frombuffer(cells, np.uint8).reshape(len(ids), length)
                edges = np.asarray(edges).reshape(length, CELLS + 1)
                for at in range(0, len(asked), QUERY_BLOCK):
                    qs = asked[at: at + QUERY_BLOCK]
                    lower, upper = bounds(whole[at: at + QUERY_BLOCK], cells, edges)
                    own = (reps == qs[:, None]) & alone
                    lower[own] = -np.inf
                    kth = np.partition(lower, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(qs), -np.inf)
                    a, b = np.nonzero((upper >= kth[:, None]) & ~own)
                    yield pd.DataFrame({"query_id": qs[a], "length": np.full(len(a), length, np.int32), "class": ids[b],
                                        "lower": lower[a, b], "upper": upper[a, b]})

    return file.mapInPandas(work, "query_id long, length int, class long, lower double, upper double")


def _parcels(queries: DataFrame) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Queries by length in parcels of bounded size; the driver holds one at a time."""
    held: dict[int, list] = {}
    room = SENT_BYTES
    for row in queries.toLocalIterator():
        held.setdefault(row["length"], []).append((row["query_id"], row["v"]))
        room -= 8 * row["length"] + 16
        if room <= 0:
            yield _packed(held)
            held, room = {}, SENT_BYTES
    if held:
        yield _packed(held)


def _packed(held: dict[int, list]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    return {n: (np.array([q for q, _ in rows], np.int64), _whole(np.array([v for _, v in rows]))) for n, rows in held.items()}


def inner_product(a: list[float] | np.ndarray, b: list[float] | np.ndarray) -> int:
    """The exact integer inner product of floor(256 x)."""
    x, y = _whole(a), _whole(b)
    if np.abs(x).max() * np.abs(y).max() * len(x) < 2.0 ** 62:
        return int(x.astype(np.int64) @ y.astype(np.int64))
    # 256 x of a large double is whole, and x itself is: the product of Python integers cannot overflow.
    whole = lambda v: [int(np.floor(i * SCALE)) if abs(i) < 2.0 ** 60 else int(i) * SCALE for i in map(float, v)]
    return sum(i * j for i, j in zip(whole(a), whole(b), strict=True))


def order_key(score: int) -> bytes:
    """Bytes that sort as the integers do."""
    size = (abs(score).bit_length() + 7) // 8
    if score >= 0:
        return b"\x01" + size.to_bytes(2, "big") + score.to_bytes(size, "big")
    return b"\x00" + (0xFFFF - size).to_bytes(2, "big") + (256 ** size + score).to_bytes(size, "big")


def _scored(pairs: DataFrame, exact: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query_id, length, class, ids, key, score)``: exact scores, pair by pair."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores = [inner_product(a, b) for a, b in zip(frame["qv"], frame["v"], strict=True)]
            yield frame[["query_id", "length", "class", "ids"]].assign(
                key=[order_key(s) for s in scores], score=[min(max(s, -2 ** 63), 2 ** 63 - 1) for s in scores])

    met = pairs.select("query_id", "length", "class").join(exact.select("class", "ids", "v"), "class").join(
        queries.select("query_id", "length", F.col("v").alias("qv")), ["query_id", "length"])
    return met.select("query_id", "length", "class", "ids", "qv", "v").mapInPandas(
        work, "query_id long, length int, class long, ids array<long>, key binary, score long")


def _partners(scored: DataFrame, k: int, per: list[str]) -> DataFrame:
    """The k best partners with their rank ``r``: ids of the classes but the query's own, equal scores by id."""
    best = Window.partitionBy(*per).orderBy(F.desc("key"), "vec_id")
    each = scored.withColumn("vec_id", F.explode("ids")).where("vec_id != query_id")
    return each.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best partners of each row of ``queries`` among ``vectors``."""
    spark = vectors.sparkSession
    ship_package(spark)
    exact = saved(classes(usable(vectors, vec_id, vector).distinct(), k + 1).withColumns(
        {"alone": F.size("ids") == 1, "class": F.monotonically_increasing_id()}), "search-exact")
    asked = saved(usable(queries, vec_id, vector).groupBy(F.col("vec_id").alias("query_id"), "length").agg(F.min("v").alias("v")),
                  "search-queries")
    file = saved(approximation_file(exact, grids(exact), CANDIDATE_BLOCK), "search-file")
    found = None
    for parcel in _parcels(asked):
        part = saved(_scan(file, spark.sparkContext.broadcast(parcel), k), "search-bounds")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], RESULT)
    per = ["query_id", "length"]
    lowest = Window.partitionBy(*per).orderBy(F.desc("lower"), "class")
    kth = found.withColumn("r", F.row_number().over(lowest)).where(F.col("r") == k).select(*per, F.col("lower").alias("least"))
    left = saved(found.join(kth, per, "left").where(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).drop("least"),
                 "search-left")
    order = Window.partitionBy(*per).orderBy(F.desc("upper"), "class")
    slices = saved(left.withColumn("r", F.row_number().over(order)).where(F.col("r") <= SLICE).select(*per, "class"), "search-slices")
    first = saved(_scored(slices, exact, asked), "search-scored")
    # A score that was cut at the least 64-bit integer says nothing about the k-th one.
    reached = F.when(F.col("score") > -2 ** 63, F.col("score").cast("double"))
    certain = _partners(first, k, per).where(F.col("r") == k).select(*per, reached.alias("reached"))
    # The score of a query of k partners, as a double, is off by less than its last bit; an upper bound has more slack than that.
    open_ = F.col("reached").isNull() | (F.col("upper") >= F.col("reached") - F.abs("reached") * 2.0 ** -50)
    rest = left.join(slices, [*per, "class"], "left_anti").join(certain, per, "left").where(open_)
    scored = first.unionAll(_scored(rest, exact, asked))
    return _partners(scored, k, ["query_id"]).select("query_id", F.col("r").cast("int").alias("rank"), "vec_id", "score")
