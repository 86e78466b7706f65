"""Vector best-fit packing of tokenised documents.

A bin has three capacities: tokens, documents and attention cost (sum of squared lengths). Pieces are placed from the
longest to the shortest into the open bin that fits under every constraint and has the best score: the weighted dot
product of demand and residual, or the weighted norm of what would be left.

Pieces of one length ask for the same, and bins with the same residuals are alike, so the plan is made on counts: how
many pieces of each length (at most ``capacity`` numbers) go into how many bins of each state. The plan says for a run of
ranks within a length which bins and offset they get; Spark deals the ranks and looks them up. No piece passes the driver.

Defined results: a null text is empty and holds the end id alone; an empty table has no pieces; repeated rows and ids
are packed one by one; equal scores go to the bin state opened first. Other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelot.llm.common import saved, ship_package, text_of

CAPACITY, END = 4096, 1
#: Documents in a bin; attention cost. Here neither is below what the tokens allow, so sequences are as few as can be.
DOCUMENTS, ATTENTION = 4096, 4096 * 4096
#: Weights of the three residuals, each as a share of its capacity.
WEIGHTS = (1.0, 0.05, 0.05)
#: Different words a Python worker remembers the ids of (some 200 bytes each); when there are more, it forgets all
#: but the third it met first, which holds the frequent ones.
KNOWN_WORDS = 1_200_000
#: Words coded in one call.
CALL_WORDS = 256
#: Pieces ranked in one task, in expectation.
RANKED_ROWS = 50_000


def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Ids of white-space separated words, remembered.

    The vocabulary drops white space and is all lower case, so words are coded apart and ASCII capitals do not matter.
    New words go through the tokenizer many at once, with a special token between them that marks the borders.
    """

    def __init__(self, path: str, known: int = KNOWN_WORDS) -> None:
        self.tokenizer, self.limit, self.known = tokenizer(path), known, {}
        special = self.tokenizer.get_added_tokens_decoder()
        self.border = min(special, default=None)
        self.mark = special[self.border].content if special else None
        # In a text with anything like a special token capitals stay as they are.
        self.marks = tuple({t.content[:2].encode() for t in special.values()})

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        data = text.encode("utf-8", "replace")
        words = (data if any(m in data for m in self.marks) else data.lower()).split()
        coded = list(map(self.known.get, words))
        holes = [i for i, ids in enumerate(coded) if ids is None]
        if holes:
            new = {words[i] for i in holes}
            if len(self.known) + len(new) > self.limit:
                self.known = dict(islice(self.known.items(), self.limit // 3))
            self._learn([w for w in new if not self._joined(w)])
            for i in holes:
                coded[i] = self.known[words[i]]
        return np.frombuffer(b"".join(coded), "<u4")

    def _joined(self, word: bytes) -> bool:
        """Code a known ASCII word with a full stop or comma behind it; these are separate for the tokenizer."""
        stem = word[:-1]
        ids = self.known.get(stem) if word[-1:] in (b".", b",") and stem[-1:].isalpha() else None
        tail = self.known.get(word[-1:]) if ids is not None else None
        if tail is None:
            return False
        self.known[word] = ids + tail
        return True

    def _learn(self, words: list[bytes]) -> None:
        alone = [w for w in words if self.mark is None or any(m in w for m in self.marks)]
        for w in alone:
            self.known[w] = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        plain = [w for w in words if w not in self.known]
        for at in range(0, len(plain), CALL_WORDS):
            some = plain[at: at + CALL_WORDS]
            ids = np.array(self.tokenizer.encode(
                self.mark.join(w.decode() for w in some), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(ids == self.border).tolist()
            data, left = ids.tobytes(), 0
            for w, cut in zip(some, [*cuts, len(ids)], strict=True):
                self.known[w] = data[4 * left: 4 * cut]
                left = cut + 1


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The coder of a Python worker, kept from task to task."""
    coder = WordIds(path)
    coder.encode(". ,")
    return coder


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every document's ids and the end id, cut at ``capacity``."""
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(coder.encode(text.as_py()), np.uint32(end)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start: start + capacity]
                    for column, value in zip(out, (key, piece, start, len(part), zlib.crc32(part.tobytes())), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(
        work, "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass(frozen=True)
class Run:
    """Pieces of ``length`` with ranks ``first`` to ``first + count - 1`` go to bins ``bin`` onwards, at ``offset``."""

    length: int
    first: int
    count: int
    bin: int
    offset: int


class _States:
    """Open bins by state: a run of consecutive bin numbers with the same residuals."""

    def __init__(self, capacities: np.ndarray) -> None:
        self.capacities, self.used = capacities, 0
        self.residual, self.bins = np.zeros((1024, 3)), np.zeros((1024, 2), np.int64)

    def add(self, residual: np.ndarray, first: int, count: int) -> None:
        if self.used == len(self.bins):
            self.residual = np.concatenate([self.residual, np.zeros_like(self.residual)])
            self.bins = np.concatenate([self.bins, np.zeros_like(self.bins)])
        self.residual[self.used], self.bins[self.used] = residual, (first, count)
        self.used += 1

    def drop(self, at: int) -> None:
        self.used -= 1
        self.residual[at], self.bins[at] = self.residual[self.used], self.bins[self.used]

    def best(self, demand: np.ndarray, weights: np.ndarray, rule: str) -> int | None:
        free = self.residual[: self.used]
        fits = np.flatnonzero((free >= demand).all(axis=1))
        if not len(fits):
            return None
        left = (free[fits] - demand) / self.capacities
        if rule == "norm":
            value = (weights * left * left).sum(axis=1)
        else:
            value = -(weights * (demand / self.capacities) * (free[fits] / self.capacities)).sum(axis=1)
        tied = fits[value <= value.min() + 1e-15]
        return int(tied[np.argmin(self.bins[tied, 0])])


def plan(counts: dict[int, int], capacity: int = CAPACITY, documents: int = DOCUMENTS, attention: float = ATTENTION,
         weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm") -> list[Run]:
    """Runs for all pieces. A run ends where a state's bins or a length's pieces do, so there are few of them."""
    capacities, share = np.array([capacity, documents, attention], float), np.array(weights)
    states, runs, bins = _States(capacities), [], 0
    for length in sorted(counts, reverse=True):
        demand, rank, rest = np.array([length, 1.0, float(length) ** 2]), 0, counts[length]
        if (demand > capacities).any():
            raise ValueError(f"a piece of {length} tokens fits no bin")
        while rest:
            at = states.best(demand, share, rule)
            if at is None:
                # New bins take as many pieces each as fit; only the last may hold fewer.
                each = int((capacities // demand).min())
                n = max(1, rest // each)
                fill = min(each, rest)
                for i in range(fill):
                    runs.append(Run(length, rank, n, bins, i * length))
                    rank += n
                rest -= n * fill
                residual = capacities - fill * demand
                if residual[0] >= 1 and residual[1] >= 1:
                    states.add(residual, bins, n)
                bins += n
                continue
            first, open_bins = (int(x) for x in states.bins[at])
            residual, n = states.residual[at].copy(), min(rest, open_bins)
            runs.append(Run(length, rank, n, first, int(capacity - residual[0])))
            if n == open_bins:
                states.drop(at)
            else:
                states.bins[at] = (first + n, open_bins - n)
            residual -= demand
            if residual[0] >= 1 and residual[1] >= 1:
                states.add(residual, first, n)
            rank, rest = rank + n, rest - n
    return runs


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with a 0-based ``rank`` within their length: ranks in hashed shares, moved by the shares before."""
    shares = max(8, -(-pieces.count() // RANKED_ROWS))
    dealt = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    moved = dealt.groupBy("length", "share").agg(F.count("*").alias("n")).withColumn(
        "moved", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "piece")
    return dealt.withColumn("inner", F.row_number().over(inside) - 1).join(moved, ["length", "share"]).withColumn(
        "rank", F.col("inner") + F.col("moved")).drop("share", "inner", "moved")


def placed(pieces: DataFrame, runs: list[Run]) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; a run is found by binary search."""
    table = np.array([(r.length, r.first, r.bin, r.offset) for r in runs], np.int64).reshape(-1, 4)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    span = 1 << 44  # ranks within a length stay far below

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        keys = rows[:, 0] * span + rows[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            found = rows[np.searchsorted(keys, length * span + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(found[:, 2] + rank - found[:, 1]), pa.array(found[:, 3])],
                [*names, "sequence_id", "offset"])

    return ranked(pieces).select(*names, "rank").mapInArrow(
        work, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, documents: int = DOCUMENTS,
         attention: float = ATTENTION, weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm",
         text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece with its sequence and offset. ``path`` is a tokenizer file every executor can open."""
    pieces = saved(pieces_of(docs, path, capacity, end, text, doc_id), "pack-pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    return placed(pieces, plan(counts, capacity, documents, attention, weights, rule))
