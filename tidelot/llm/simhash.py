"""SimHash near-dedup by pigeonhole blocks.

A fingerprint is cut into four blocks. Two that differ in at most two bits agree in at least two of them, so each
distinct fingerprint is filed under its six pairs of blocks, and only rows of one file are compared. A file of more
than :data:`FILE_ROWS` fingerprints is not paired: each member is spread over itself and its one-bit neighbours outside
the agreed blocks. Two members within two bits meet at one of these, so links are found with a fixed number of
rows for each member. Every link is verified by its Hamming distance.

Defined results: a null text counts as empty; a text without words has fingerprint zero and is linked like any other;
repeated rows and ids keep one result row each; a null id takes part and counts as the largest id. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.llm.common import saved, ship_package, text_of
from tidelot.llm.components import components

SHINGLE, DISTANCE, BLOCKS, SEED = 3, 2, 4, 42
#: Files up to this size are compared pair by pair, larger ones through one-bit neighbours; both ways are exact.
FILE_ROWS = 32
_STEP = 8192


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash as a signed integer. ASCII letters are lower-cased, words end at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, last, _STEP):
        end = min(last, at + _STEP)
        columns = [words[at + i: end + i] for i in range(shingle)] if len(words) >= shingle else None
        joined = map(b" ".join, zip(*columns, strict=True)) if columns else [b" ".join(words)]
        hashes = np.array([digest(x, SEED) for x in joined], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * counts > last).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and the ``fingerprint`` (long) of each row's text."""
    ship_package(docs.sparkSession)
    schema = ", ".join(f"{c} {t}" for c, t in docs.select(*keep).dtypes) + ", fingerprint long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(found, pa.int64())], [*keep, "fingerprint"])

    return docs.select(*keep, text_of(text).alias("__text")).mapInArrow(work, schema)


def _mask(block: int, blocks: int) -> int:
    low, high = 64 * block // blocks, 64 * (block + 1) // blocks
    return ((1 << (high - low)) - 1) << low


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _files(fps: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``(f, part, agreed)``: each fingerprint under every choice of blocks that a close one must share."""
    masks = [sum(_mask(b, blocks) for b in chosen) for chosen in combinations(range(blocks), blocks - distance)]
    parts = F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("f").bitwiseAND(F.lit(_signed(m))).alias("agreed"))
        for i, m in enumerate(masks)])
    return fps.select("f", F.explode(parts).alias("p")).select("f", "p.part", "p.agreed")


def _free_bits(distance: int, blocks: int) -> Column:
    """Array column of the one-bit masks outside the agreed blocks of ``part``, and zero."""
    choices = []
    for i, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        agreed = sum(_mask(b, blocks) for b in chosen)
        free = [0] + [_signed(1 << b) for b in range(64) if not agreed >> b & 1]
        choices.append((i, F.array(*[F.lit(x).cast("long") for x in free])))
    column = F.when(F.col("part") == choices[0][0], choices[0][1])
    for i, free in choices[1:]:
        column = column.when(F.col("part") == i, free)
    return column


def close(a: Column, b: Column, distance: int = DISTANCE) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, file_rows: int = FILE_ROWS) -> DataFrame:
    """Verified links ``(a, b)`` among distinct fingerprints ``f``; they join exactly what lies within ``distance``.

    The way through neighbours is for a distance of two: members of a file within two bits share a one-bit neighbour.
    """
    if distance != 2:
        raise ValueError("files are laid out for a distance of two bits")
    filed = saved(_files(fps, distance, blocks), "simhash-files")
    sizes = filed.groupBy("part", "agreed").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(filed.join(sizes, ["part", "agreed"]), "simhash-shared")
    small = shared.where(F.col("n") <= file_rows)
    pairs = (
        small.select("part", "agreed", F.col("f").alias("a"))
        .join(small.select("part", "agreed", F.col("f").alias("b")), ["part", "agreed"])
        .where(F.col("a") < F.col("b")).select("a", "b")
    )
    near = (
        shared.where(F.col("n") > file_rows)
        .select("f", F.explode(_free_bits(distance, blocks)).alias("bit"))
        .select("f", F.col("f").bitwiseXOR(F.col("bit")).alias("near"))
    )
    # Few fingerprints can share a neighbour: itself and those one bit away.
    least = near.groupBy("near").agg(F.min("f").alias("a"), F.max("f").alias("z")).where("a < z").drop("z")
    spread = near.join(least, "near").where("a < f").select("a", F.col("f").alias("b"))
    return pairs.union(spread).where(close(F.col("a"), F.col("b"), distance)).distinct()


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: one row per row of ``docs``; the component is its smallest id."""
    hashed = saved(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text), ["doc_id"], text, shingle),
                   "simhash")
    distinct = saved(hashed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select(F.col("fingerprint").alias("f"))))
    placed = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return hashed.join(named.select("fingerprint", "component_id"), "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
