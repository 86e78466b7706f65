"""Ranked lexical search over a document FP-tree.

Only terms that some item asks for matter, so a document becomes its restricted term vector: the ranks of its item terms,
most frequent term first, with their counts. Sorted vectors are a trie: documents that share a path lie side by side, and a
node is a range of them with a common beginning. A node bounds what lies below it by the largest count of every term and the
least length norm ``m``, for the contribution of a term grows with its count and falls with ``m``. The search walks down
depth first, best bound first, with the items that can still gain something there; an item leaves a subtree whose bound is
below its k-th best score so far. Small ranges are scored exactly.

Each task holds one tree of at most :data:`TREE_ROWS` documents and :data:`TREE_ENTRIES` counts at a time and keeps the k best of each item from tree to
tree; the k best of all tasks are ranked by Spark. Texts are read once for a block of items, nothing but counts and the
restricted vectors is kept. A block has at most :data:`BLOCK_ITEMS` items and :data:`BLOCK_TERMS` terms (or one item with
more), which bounds what a task is given; more items are more blocks.

Defined results: a null or empty text has no term and matches nothing; an item without terms has no rows; rows of one item
id ask with all their terms together, and a null item id is an id; repeated documents are ranked one by one, equal scores by
ascending doc_id, a null doc_id last; ids are read as 64-bit integers. Other columns are not read, empty tables give
an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelot.llm.common import saved, ship_package

TOP = 50
BLOCK_ITEMS, BLOCK_TERMS = 512, 8192
TREE_ROWS, TREE_ENTRIES, LEAF_ROWS = 16_384, 2_000_000, 48
RESULT = "item_id long, rank int, doc_id long, score long"

#: Every byte as it counts in a term: upper-case ASCII letters lowered, other ASCII but digits and letters a blank.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats: runs of ASCII letters, digits and anything beyond ASCII."""
    return text.translate(_FOLDED).split()


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, terms)``: the distinct terms of each item, as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(x.as_py() or b""))) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(work, "item_id long, terms array<binary>").select(
        "item_id", F.explode("terms").alias("term")).groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


@dataclass(frozen=True)
class Block:
    """Some items and the terms they ask for; ``asks`` holds the places of an item's terms in ``terms``."""

    ids: list[int | None]
    asks: list[list[int]]
    terms: list[bytes]


def blocks(asked: DataFrame, most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """Items in blocks of bounded size; the driver holds one block and one partition of items at a time."""
    ids: list[int | None] = []
    asks: list[list[int]] = []
    places: dict[bytes, int] = {}
    for row in asked.orderBy("item_id").toLocalIterator():
        words = [bytes(t) for t in row["terms"]]
        more = sum(w not in places for w in words)
        if ids and (len(ids) >= most_items or len(places) + more > most_terms):
            yield Block(ids, asks, list(places))
            ids, asks, places = [], [], {}
        ids.append(row["item_id"])
        asks.append([places.setdefault(w, len(places)) for w in words])
    if ids:
        yield Block(ids, asks, list(places))


def restricted(docs: DataFrame, terms: list[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, places, counts)``: all terms of a text counted, those of ``terms`` one by one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i + 1 for i, t in enumerate(terms)}
        for batch in batches:
            sizes, places, counts = [], [], []
            for x in batch.column(1):
                words = terms_of(x.as_py() or b"")
                found = Counter(filter(None, map(known.get, words)))
                sizes.append(len(words))
                places.append([i - 1 for i in found])
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "places", "counts"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(work, "doc_id long, n long, places array<int>, counts array<long>")


@dataclass(frozen=True)
class Weights:
    """Terms in the order of their ranks: ``rank`` of each place, and by rank the ``weight`` and which item asks for it."""

    rank: np.ndarray
    weight: np.ndarray
    asks: np.ndarray


def weigh(block: Block, with_terms: int, frequencies: dict[int, int]) -> Weights:
    """Weights and frequency order from the number of documents with terms and of those that hold each term."""
    df = np.array([frequencies.get(i, 0) for i in range(len(block.terms))], np.int64)
    order = np.argsort(-df, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    weight = np.array([math.floor(1000 * math.log((2 * with_terms + 2) / (2 * int(df[i]) + 1))) for i in order], np.int64)
    asks = np.zeros((len(block.ids), len(order)))
    for i, places in enumerate(block.asks):
        asks[i, rank[places]] = 1
    return Weights(rank, weight, asks)


class Tree:
    """Sorted restricted vectors of some documents. Equal vectors with an equal norm are one leaf with its k first ids."""

    def __init__(self, vectors: list[tuple[bytes, bytes, int]], ids: list[list[tuple[bool, int]]]) -> None:
        order = sorted(range(len(vectors)), key=vectors.__getitem__)
        ranks = [np.frombuffer(vectors[i][0], ">u4") for i in order]
        self.start = np.concatenate([[0], np.cumsum([len(r) for r in ranks])]).astype(np.int64)
        self.rank = np.concatenate(ranks).astype(np.int64)
        self.count = np.concatenate([np.frombuffer(vectors[i][1], np.int64) for i in order])
        self.norm = np.array([vectors[i][2] for i in order], np.int64)
        self.ids = [ids[i] for i in order]

    def largest(self, low: int, high: int, terms: int) -> np.ndarray:
        """The largest count of every term below a node."""
        most = np.zeros(terms, np.int64)
        part = slice(self.start[low], self.start[high])
        np.maximum.at(most, self.rank[part], self.count[part])
        return most

    def counts(self, low: int, high: int, terms: int) -> np.ndarray:
        """The counts of every document of a range, a row each."""
        rows = np.zeros((high - low, terms), np.int64)
        part = slice(self.start[low], self.start[high])
        rows[np.repeat(np.arange(high - low), np.diff(self.start[low: high + 1])), self.rank[part]] = self.count[part]
        return rows

    def children(self, low: int, high: int, depth: int) -> tuple[list[tuple[int, int]], int]:
        """Ranges below a node that begin with ``depth`` common ranks, and the depth they share; chains are one step."""
        while True:
            at = self.start[low:high] + depth
            inside = at < self.start[low + 1: high + 1]
            if not inside.any():
                middle = (low + high) // 2  # nothing but norms and counts differs
                return [(low, middle), (middle, high)], depth
            next_rank = np.where(inside, self.rank[np.minimum(at, len(self.rank) - 1)], -1)
            cuts = np.flatnonzero(np.diff(next_rank)) + low + 1
            if len(cuts):
                edges = [low, *cuts.tolist(), high]
                return list(zip(edges[:-1], edges[1:], strict=True)), depth + 1
            depth += 1


class Search:
    """The k best documents of every item of a block, from tree to tree."""

    def __init__(self, weights: Weights, k: int) -> None:
        self.w, self.k = weights, k
        self.best: list[list[tuple[int, bool, int]]] = [[] for _ in weights.asks]
        #: The score an item's next document has to reach.
        self.least = np.ones(len(weights.asks), np.int64)

    def gains(self, counts: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Contribution of each term, a row for each row of counts; sums stay below 2^53, so doubles hold them exactly."""
        return (self.w.weight * ((1_000_000_000 * counts) // np.maximum(1, 1000 * counts + 20 * norms[:, None]))).astype(float)

    def walk(self, tree: Tree) -> None:
        terms, everything = len(self.w.weight), np.arange(len(self.w.asks))
        stack = [(0, len(tree.norm), 0, everything, np.full(len(everything), 2 ** 62))]
        while stack:
            low, high, depth, items, bound = stack.pop()
            items = items[bound >= self.least[items]]
            if not len(items):
                continue
            if high - low <= LEAF_ROWS:
                self.score(tree, low, high, items)
                continue
            parts, deeper = tree.children(low, high, depth)
            small, large = [], []
            for part in parts:  # neighbours that are small together are one leaf
                if small and part[1] - small[-1][0] <= LEAF_ROWS:
                    small[-1] = (small[-1][0], part[1])
                else:
                    (small if part[1] - part[0] <= LEAF_ROWS else large).append(part)
            below = [(*p, depth) for p in small] + [(*p, deeper) for p in large]
            most = np.stack([tree.largest(a, b, terms) for a, b, _ in below])
            norms = np.array([tree.norm[a:b].min() for a, b, _ in below])
            bounds = self.w.asks[items] @ self.gains(most, norms).T
            for i in np.argsort(bounds.max(axis=0), kind="stable"):
                stack.append((*below[i], items, bounds[:, i]))

    def score(self, tree: Tree, low: int, high: int, items: np.ndarray) -> None:
        counts = tree.counts(low, high, len(self.w.weight))
        scores = (self.w.asks[items] @ self.gains(counts, tree.norm[low:high]).T).astype(np.int64)
        for a, b in zip(*np.nonzero(scores >= self.least[items][:, None]), strict=True):
            item, score = int(items[a]), int(scores[a, b])
            if score < self.least[item]:
                continue
            found = self.best[item] + [(-score, *x) for x in tree.ids[low + b]]
            self.best[item] = sorted(found)[: self.k]
            if len(found) >= self.k:
                self.least[item] = -self.best[item][-1][0]


def _trees(batches: Iterator[pa.RecordBatch], rank: np.ndarray, k: int) -> Iterator[Tree]:
    """Documents with a term of the block, gathered into trees of bounded size."""
    leaves: dict[tuple[bytes, bytes, int], list[tuple[bool, int]]] = {}
    entries = 0
    for batch in batches:
        for doc, norm, places, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            ranks = rank[places]
            order = np.argsort(ranks)
            vector = (ranks[order].astype(">u4").tobytes(), np.array(counts, np.int64)[order].tobytes(), norm)
            known = leaves.get(vector)
            if known is None:
                leaves[vector] = known = []
                entries += len(places)
            known.append((doc is None, doc or 0))
            if len(known) > 4 * k:  # copies: the k first ids are all that can be ranked
                known.sort()
                del known[k:]
            if len(leaves) >= TREE_ROWS or entries >= TREE_ENTRIES:
                yield Tree(list(leaves), list(leaves.values()))
                leaves, entries = {}, 0
    if leaves:
        yield Tree(list(leaves), list(leaves.values()))


def _search_block(docs: DataFrame, block: Block, k: int, doc_id: str, text: str) -> DataFrame:
    """``(item_id, doc_id, score)`` of the k best of each task."""
    vectors = saved(restricted(docs, block.terms, doc_id, text), "lexical-vectors")
    totals = vectors.agg(F.count_if(F.col("n") > 0).alias("with_terms"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # One row for each term of the block.
    frequencies = dict(map(tuple, vectors.select(F.explode("places").alias("p")).groupBy("p").count().collect()))
    weights = weigh(block, totals["with_terms"], frequencies)
    ids = block.ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(weights, k)
        for tree in _trees(batches, weights.rank, k):
            search.walk(tree)
        found = [(ids[i], None if null else doc, -score) for i, best in enumerate(search.best) for score, null, doc in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["item_id", "doc_id", "score"])

    wide = F.lit(50).cast("decimal(38,0)") * F.col("n") * F.lit(totals["with_terms"])
    norm = F.lit(100 - 50) + F.expr("_wide div _all").cast("long")
    ready = vectors.where(F.size("places") > 0).withColumns(
        {"_wide": wide.cast("decimal(38,0)"), "_all": F.lit(max(1, totals["terms"])).cast("decimal(38,0)")}).select(
        "doc_id", norm.alias("m"), "places", "counts")
    return ready.mapInArrow(work, "item_id long, doc_id long, score long")


def top_documents(docs: DataFrame, items: DataFrame, k: int = TOP, *, doc_id: str = "doc_id", item_id: str = "item_id",
                  text: str = "text", block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k documents of highest score above zero for each item."""
    spark = docs.sparkSession
    ship_package(spark)
    asked = saved(item_terms(items, item_id, text), "lexical-items")
    found = [_search_block(docs, block, k, doc_id, text) for block in blocks(asked, block_items, block_terms)]
    if not found:
        return spark.createDataFrame([], RESULT)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
