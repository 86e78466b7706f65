"""Exact Jaccard join of texts as sets of word shingles: size-banded tiles, hashed bitmap signatures, sorted arrays.

Equal sets are one class. A set of n shingles that is similar to another shares at least ceil(t n) of them, so the two
share one of the first n - ceil(t n) + 1 shingles of each in any common order: a class is filed under these. The order puts
shingles that many texts have last (counted over all texts), so that a passage of a third of all documents files nothing
together unless the documents consist of such passages. Files of one shingle and one size band, each with the next band
as guests (similar sets are at most a band apart), are the tiles.

1. Files are read sorted, one row after the other. Every member is held against the first :data:`HEADS` members of its band and
   of the band below, by a hash of the class, which settles groups of near copies with a few pairs a member. Files of one
   member end here, and so do bands of no more members than that, for all their pairs are formed.
2. What is still in different components is compared by signatures, tile against tile: bit parities of hashed shingles,
   whose differing bits are at most the shingles that differ, so the overlap is bounded from above. A file's members in small
   components form its tiles; a component of :data:`LARGE` members or more is cut into tiles of its own, once for all its files, and
   meets the members of other components that share a file with it. A member hands on its nearest few partners that reach the bound.
3. Pairs are verified on sorted arrays of hashes. Sets are hashed again from the texts that are in a pair, once a class.

Steps 2 and 3 are repeated for the members that had more such partners, with four times as many each time and without pairs that were
refuted, until there are none: then every similar pair lies in one component. Tiles have at most
:data:`TILE_ROWS` members a side; longer files and components are cut.

A shingle is 64 bits, mixed from 64-bit hashes of its words. Defined results: ASCII letters are lower-cased, words end
at ASCII white space; a text of fewer words than a shingle is one shingle; null, empty and blank texts have no shingle
and are linked with nothing; repeated rows and ids keep one row each; a null id takes part and counts as the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.llm.common import saved, ship_package
from tidelot.llm.components import components

SEED = 42
#: A shingle counts as frequent if that many texts of a chunk of :data:`CHUNK` shingles have it; so many are remembered.
FREQUENT, CHUNK, REMEMBERED = 4, 4_000_000, 1 << 18
#: Members of one side of a tile, partners of a class that are verified together, and members that make a component large.
TILE_ROWS, FIRST_ROWS, LARGE = 1024, 2048, 256
#: Members of a file that all others are held against, and partners that a member hands on in the first round.
HEADS, NEAREST = 4, 16
#: Buckets of a signature for each shingle, at least.
BUCKETS = 4
#: 64-bit words of a Bloom filter of rows, at most, and bits that a row sets in its word.
FILTER_WORDS, FILTER_BITS = 1 << 18, 3
_WORDS = 1 << 20


@dataclass(frozen=True)
class Rule:
    """Words of a shingle and the least similarity."""

    shingle: int = 4
    least: Fraction = Fraction(85, 100)

    def first(self, n: int) -> int:
        """How many shingles of a set are filed."""
        return n - -(-n * self.least.numerator // self.least.denominator) + 1

    def band(self, n: Column) -> Column:
        """Similar sets are in the same or in neighbouring bands; the margin is for the rounding of logarithms."""
        return F.floor(F.log(n.cast("double")) / (-log(float(self.least)) * (1 + 1e-9))).cast("int")

    def sizes_fit(self, n: Column, m: Column) -> Column:
        return F.least(n, m) * self.least.denominator >= F.greatest(n, m) * self.least.numerator

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sorted arrays of distinct hashes reach the least similarity."""
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both * self.least.denominator >= (len(a) + len(b) - both) * self.least.numerator

    def most_apart(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The most shingles that two similar sets of these sizes do not share: n + m - 2 ceil(t / (1 + t) (n + m))."""
        up, down = self.least.numerator, self.least.numerator + self.least.denominator
        return n + m - 2 * -(-(n + m) * up // down)


class Shingler:
    """Sets of shingles of texts; remembers the hashes of words."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}
        odd = [xxhash.xxh64_intdigest(f"place {i}", SEED) | 1 for i in range(words)]
        self.factors = np.array(odd, np.uint64)

    def _hash(self, word: bytes) -> int:
        if len(self.known) >= _WORDS:
            self.known.clear()
        self.known[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles of a UTF-8 text."""
        words = (text or b"").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known, fresh = self.known, self._hash
        hashes = np.fromiter((known.get(w) or fresh(w) for w in words), np.uint64, len(words))
        if len(words) < self.words:  # tells a short sequence from the beginning of a longer one
            hashes = np.append(hashes, np.full(self.words - len(words), len(words), np.uint64))
        n = len(hashes) - self.words + 1
        with np.errstate(over="ignore"):
            mixed = hashes[:n] * self.factors[0]
            for i in range(1, self.words):
                mixed = (mixed ^ (mixed >> np.uint64(29))) + hashes[i: i + n] * self.factors[i]
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
        return np.unique(mixed ^ (mixed >> np.uint64(28)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Parities of the hashes in each of a power of two of buckets, as 64-bit words."""
    bits = max(64, 1 << (BUCKETS * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, length: int) -> np.ndarray:
    """A signature of fewer buckets: halves are added until ``length`` words are left."""
    while len(words) > length:
        words = words[: len(words) // 2] ^ words[len(words) // 2:]
    return words


def _content(rows: DataFrame, row: str, text: str) -> DataFrame:
    return rows.select(F.col(row).cast("long").alias("row"), F.col(text).cast("string").cast("binary").alias("content"))


def keyed(rows: DataFrame, row: str, text: str, rule: Rule) -> DataFrame:
    """``(row, key, n, shingle)``: a digest of each row's set and its size; shingles that several texts have, in ``n`` of a task's chunk.

    ``shingle`` is null in a row of the first kind, ``row`` and ``key`` in one of the second. Tasks count whole chunks of texts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "key", "n", "shingle"]
        sets, room, shingles = [], CHUNK, Shingler(rule.shingle)

        def out() -> pa.RecordBatch:
            every = np.concatenate(sets or [np.empty(0, np.uint64)])
            sets.clear()
            every.sort()  # in place: a chunk is held once
            k = max(0, len(every) - FREQUENT + 1)
            many = np.unique(every[:k][every[:k] == every[len(every) - k:]])
            counts = np.searchsorted(every, many, "right") - np.searchsorted(every, many)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(many), pa.int64()), pa.nulls(len(many), pa.binary()), pa.array(counts, pa.int64()), pa.array(many.view(np.int64))], names)

        for batch in batches:
            keys, sizes = [], []
            for x in batch.column(1):
                sets.append(hashes := shingles(x.as_py()))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                sizes.append(len(hashes))
                room -= len(hashes)
                if room <= 0:
                    yield out()
                    room = CHUNK
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.nulls(len(keys), pa.int64())], names)
        yield out()

    return _content(rows, row, text).mapInArrow(work, "row long, key binary, n long, shingle long")


def frequent_shingles(keys: DataFrame) -> np.ndarray:
    """Shingles that many texts have by :func:`keyed`, the rarest first; a bounded number.

    Which shingles are in the list decides on the size of files, never on results: any common order files similar sets
    together.
    """
    counted = keys.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n"))
    most = counted.orderBy(F.desc("n"), "shingle").limit(REMEMBERED).toArrow()
    shingles, counts = most.column("shingle").to_numpy(), most.column("n").to_numpy()
    return shingles.view(np.uint64)[np.lexsort((shingles, counts))]


def _filed(rows: DataFrame, row: str, text: str, rule: Rule, sent: Broadcast) -> DataFrame:
    """``(node, files, bits)``: the row, the shingles its set is filed under, its signature."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        place = np.argsort(frequent)
        ordered, shingles = frequent[place], Shingler(rule.shingle)
        for batch in batches:
            files, bits = [], []
            for x in batch.column(1):
                hashes = shingles(x.as_py())
                if not len(hashes):
                    files.append([])
                    bits.append(b"")
                    continue
                order = hashes >> np.uint64(1)
                if len(ordered):
                    at = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
                    many = ordered[at] == hashes
                    order[many] = np.uint64(1 << 63) + place[at[many]].astype(np.uint64)
                # Hashes that are equal but for the last bit come in the order of their whole value.
                first = np.lexsort((hashes, order))[: rule.first(len(hashes))]
                files.append(hashes[first].view(np.int64))
                bits.append(signature(hashes).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(files, pa.list_(pa.int64())), pa.array(bits, pa.binary())], ["node", "files", "bits"])

    return _content(rows, row, text).mapInArrow(work, "node long, files array<long>, bits binary")


def classes(rows: DataFrame, row: str, text: str, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Each row's class, ``(row, key, n)``, and the classes, ``(node, key, n, files, bits)``; a node is a class's first row."""
    # Sets are hashed twice: digests tell which rows are first, so signatures and files are written of these alone, and once.
    keys = saved(keyed(rows, row, text, rule), "jaccard-keys")
    frequent = rows.sparkSession.sparkContext.broadcast(frequent_shingles(keys))
    hashed = keys.where("shingle is null").select("row", "key", "n")
    firsts = hashed.where("n > 0").groupBy("key").agg(F.min(F.struct("row", "n")).alias("first")).select(
        F.col("first.row").alias("node"), "key", F.col("first.n").alias("n"))
    # Neither side of a join that moves sets or signatures is bounded, so none is ever broadcast, at no size.
    found = _filed(rows, row, text, rule, frequent).where("size(files) > 0").join(firsts.hint("merge"), "node")
    return hashed, saved(found.select("node", "key", "n", "files", "bits"), "jaccard-classes")


def _asked(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of ``table`` whose ``key`` is in ``wanted (key)``, distinct keys, few as a rule.

    A Bloom filter goes to the rows, so what is not wanted is not shuffled but for a few of them; the join is exact. The
    filter is :data:`FILTER_WORDS` words at most, however many keys there are; a full one lets all rows pass. A semi join
    would be moved below the filter, and shuffle all rows.
    """
    place = F.xxhash64(key)
    word = F.pmod(place, F.lit(FILTER_WORDS)).cast("int")
    mask = F.lit(0).cast("long")
    for i in range(FILTER_BITS):
        at = F.shiftrightunsigned(place, 63 - 6 * (i + 1)).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    cells = wanted.select(word.alias("filter_word"), mask.alias("mask")).groupBy("filter_word").agg(F.bit_or("mask").alias("filter_bits"))
    passed = table.join(F.broadcast(cells), word == F.col("filter_word")).where(F.col("filter_bits").bitwiseAND(mask) == mask)
    return passed.select(*table.columns).join(wanted.hint("merge"), key).select(*table.columns)


def _met(pairs: DataFrame, table: DataFrame, names: list[str]) -> DataFrame:
    """``pairs (a, b)`` with the columns ``names`` of ``table (node, ...)`` for both, as ``x_`` and ``y_``.

    The first node of many pairs is sent in copies, one for :data:`FIRST_ROWS` partners, so no task gets all of them.
    """
    copies = pairs.groupBy("a").agg((F.floor((F.count("*") - 1) / FIRST_ROWS) + 1).alias("copies"))
    spread = pairs.join(copies, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("copies")).alias("copy"))
    firsts = copies.join(table.hint("merge"), copies["a"] == table["node"]).select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), *[F.col(c).alias(f"x_{c}") for c in names])
    others = table.select(F.col("node").alias("b"), *[F.col(c).alias(f"y_{c}") for c in names])
    return spread.join(firsts.hint("merge"), ["a", "copy"]).join(others.hint("merge"), "b").select("a", "b", *[f"{side}_{c}" for c in names for side in "xy"])


def plausible(pairs: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures leave it open that they are similar."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n, m, x, y in zip(*(batch.column(i) for i in range(2, 6)), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                words = min(len(x), len(y))
                apart = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                good.append(apart <= rule.most_apart(n.as_py(), m.as_py()))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good, pa.bool_())) for i in (0, 1)], ["a", "b"])

    return _met(pairs, found, ["n", "bits"]).mapInArrow(work, "a long, b long")


def verified(pairs: DataFrame, rows: DataFrame, row: str, text: str, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose sets reach the least similarity. Each node of a pair is hashed once."""

    def hash_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(rule.shingle)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())], ["node", "set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [rule.similar(*(np.frombuffer(y.as_buffer(), np.uint64) for y in x))
                    for x in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good, pa.bool_())) for i in (0, 1)], ["a", "b"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = saved(_asked(_content(rows, row, text), wanted, "row").mapInArrow(hash_again, "node long, set binary"), "jaccard-sets")
    return _met(pairs, sets, ["set"]).mapInArrow(compare, "a long, b long")


def _grouped(filed: DataFrame, rule: Rule) -> DataFrame:
    """``(a, b, file, band, guest)``: pairs with the first members of a file's band, and members ``a`` of large bands.

    ``filed`` is ``(file, band, node, n)``; a row is a pair where ``b`` is not null. A task holds the heads of two bands.
    """
    up, down = rule.least.numerator, rule.least.denominator

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "band", "node", "n"]
        held = None
        at = (None, None)
        heads: list[tuple[int, int]] = []
        below: list[tuple[int, int]] = []
        count, many_below = 0, False

        def walk(rows: pa.Table) -> pa.RecordBatch:
            nonlocal at, heads, below, count, many_below
            out: list[tuple] = []
            for file, band, node, n in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
                if (file, band) != at:
                    follows = at == (file, band - 1)
                    below, many_below = (heads, count > HEADS) if follows else ([], False)
                    at, heads, count = (file, band), [], 0
                for other, m in (*heads, *below):
                    if min(n, m) * down >= max(n, m) * up:
                        out.append((node, other, None, None, None) if node < other else (other, node, None, None, None))
                count += 1
                if count <= HEADS:
                    heads.append((node, n))
                else:
                    if count == HEADS + 1:
                        out += [(x, None, file, band, False) for x, _ in heads]
                    out.append((node, None, file, band, False))
                if many_below:
                    out.append((node, None, file, band - 1, True))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, types, strict=True)], ["a", "b", "file", "band", "guest"])

        for batch in batches:
            more = pa.Table.from_batches([batch])
            rows = more if held is None else pa.concat_tables([held, more])
            # The last row waits for the next batch, which may begin with its file; the first was kept for the same reason.
            file = rows.column("file").to_numpy()
            same = file[1:] == file[:-1]
            repeated = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            if held is not None:
                repeated[0] |= at[0] == file[0]
            held = rows.slice(len(file) - 1)
            yield walk(rows.slice(0, len(file) - 1).filter(pa.array(repeated[:-1])))
        if held is not None:
            yield walk(held)

    dealt = filed.repartition("file").withColumn("order", F.xxhash64("node")).sortWithinPartitions("file", "band", "order", "node")
    return dealt.select("file", "band", "node", "n").mapInArrow(work, "a long, b long, file long, band int, guest boolean")


def _nearest(cells: dict, low: int, high: int, rule: Rule, most: int) -> list[tuple[int, int]]:
    """Pairs of nodes of a tile that may be similar: of different components, not refuted, the nearest ``most`` of each member.

    A member with more of them is in the result as ``(node, -1)``.
    """
    node, n, root, side, guest, todo = (cells[c][low:high] for c in ("node", "n", "root", "side", "guest", "todo"))
    bits = [np.frombuffer(x.as_buffer(), np.uint64) for x in cells["bits"][low:high]]
    words = min(map(len, bits))
    table = np.stack([folded(x, words) for x in bits])
    refuted = {(a, b) for a, others in zip(node.tolist(), cells["refuted"][low:high].to_pylist(), strict=True) for b in others or ()}
    two = bool((side != side[0]).any())
    out = []
    for i in np.flatnonzero(side == 1).tolist() if two else range(high - low - 1):
        allowed = (root != root[i]) & ~(guest & guest[i]) & (todo | todo[i])
        others = np.flatnonzero(allowed & (side == 0)) if two else np.flatnonzero(allowed[i + 1:]) + i + 1
        if not len(others):
            continue
        apart = np.bitwise_count(table[others] ^ table[i]).sum(axis=1, dtype=np.int64)
        near = apart <= rule.most_apart(n[others], n[i])
        kept = 0
        for j in others[near][np.argsort(apart[near], kind="stable")].tolist():
            pair = (int(min(node[i], node[j])), int(max(node[i], node[j])))
            if pair in refuted:
                continue
            if kept == most:
                out.append((int(node[i]), -1))
                break
            out.append(pair)
            kept += 1
    return out


def _tile_pairs(tiles: DataFrame, rule: Rule, most: int) -> DataFrame:
    """``(a, b)`` that may be similar. Rows come sorted by tile; a task holds one tile and a batch at a time."""
    names = ["tile", "node", "n", "root", "side", "guest", "todo", "bits", "refuted"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(table: pa.Table, edges: list[int]) -> pa.RecordBatch:
            whole = table.combine_chunks()
            cells = {c: whole.column(c).to_numpy() for c in ("node", "n", "root", "side", "guest", "todo")}
            cells |= {c: whole.column(c).combine_chunks() for c in ("bits", "refuted")}
            out = []
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if (cells["root"][low:high] != cells["root"][low]).any():
                    out += _nearest(cells, low, high, rule, most)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            key = held.column("tile").to_pylist()
            edges = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1])]
            if len(edges) > 1:
                yield pairs(held.slice(0, edges[-1]), edges)
                held = held.slice(edges[-1])
        if held is not None and held.num_rows:
            yield pairs(held, [0, held.num_rows])

    return tiles.select(*names).repartition("tile").sortWithinPartitions("tile").mapInArrow(work, "a long, b long")


def _parts(count: str, tile_rows: int) -> Column:
    return (F.floor((F.col(count) - 1) / tile_rows) + 1).cast("int")


def _dealt(parts: Column) -> Column:
    return F.pmod(F.xxhash64("node"), parts).cast("int")


def _file_tiles(members: DataFrame, nodes: DataFrame, tile_rows: int) -> DataFrame:
    """``(tile, node, side, guest)`` of the files that hold several small components."""
    place = ["file", "band"]
    small = members.join(nodes.where("not large").select("node", "root"), "node")
    still = small.groupBy(*place).agg(
        F.count("*").alias("k"), F.min("root").alias("x"), F.max("root").alias("y"), F.bool_or(~F.col("guest")).alias("own"))
    parts = _parts("k", tile_rows)
    dealt = small.join(still.where("x < y and own").select(*place, parts.alias("parts")), place).withColumn("part", _dealt(F.col("parts")))
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least("part", j).alias("i"), F.greatest("part", j).alias("j"), (j < F.col("part")).cast("int").alias("side")))
    met = dealt.select(*place, "node", "guest", F.explode(meets).alias("m"))
    return met.select(F.concat_ws(":", "file", "band", "m.i", "m.j").alias("tile"), "node", "m.side", "guest")


def _component_tiles(members: DataFrame, nodes: DataFrame, tile_rows: int) -> DataFrame:
    """``(tile, node, side, guest)`` of large components (side 0) and of the nodes of others that share a file with them."""
    large = nodes.where("large").select("node", "root", "own_band")
    held_as = F.col("guest").alias("held_as_guest")
    inside = members.join(large.select("node", "root"), "node").select("file", "band", held_as, "root").distinct()
    around = members.join(nodes.select("node", F.col("root").alias("other")), "node")
    asking = saved(around.join(inside, ["file", "band"]).where("other != root and not (guest and held_as_guest)").select(
        "node", "root", (F.col("band") + F.col("held_as_guest").cast("int")).alias("band")).distinct(), "jaccard-asking")
    place = ["root", "band"]
    asked = asking.groupBy(*place).agg(F.count("*").alias("k"))
    held = large.select("root", F.col("own_band").alias("band")).groupBy(*place).agg(F.count("*").alias("m"))
    sized = saved(asked.join(held, place).select(*place, _parts("k", tile_rows).alias("blocks"), _parts("m", tile_rows).alias("parts")),
                  "jaccard-sized")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = large.select("node", "root", F.col("own_band").alias("band")).join(sized, place).select(
        "node", *place, _dealt(F.col("parts")).alias("part"), every("blocks").alias("block"), F.lit(0).alias("side"))
    right = asking.join(sized, place).select(
        "node", *place, every("parts").alias("part"), _dealt(F.col("blocks")).alias("block"), F.lit(1).alias("side"))
    return left.unionByName(right).select(
        F.concat_ws(":", F.lit("c"), "root", "band", "part", "block").alias("tile"), "node", "side", F.lit(False).alias("guest"))


def links(found: DataFrame, rows: DataFrame, row: str, text: str, rule: Rule, tile_rows: int = TILE_ROWS, large: int = LARGE,
          known: DataFrame | None = None) -> DataFrame:
    """``(node, root)`` of the components of all similar pairs among the nodes of ``classes``, for nodes that are no root.

    ``known`` are pairs ``(a, b)`` from elsewhere that are held against each other first.
    """
    filed = found.select("node", "n", F.explode("files").alias("file"), rule.band(F.col("n")).alias("band"))
    grouped = saved(_grouped(filed, rule), "jaccard-grouped")
    members = grouped.where("b is null").select("file", "band", "guest", F.col("a").alias("node"))
    first = grouped.where("b is not null").select("a", "b")
    if known is not None:
        first = first.unionByName(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b"))
    maybe = saved(plausible(saved(first.distinct(), "jaccard-first"), found, rule), "jaccard-pairs")
    inside = saved(_asked(found.select("node", "n", "bits", rule.band(F.col("n")).alias("own_band")), members.select("node").distinct(), "node"),
                   "jaccard-inside")
    roots = rows.sparkSession.createDataFrame([], "node long, root long")
    refuted, todo, most = None, None, NEAREST
    while True:
        good = saved(verified(maybe, rows, row, text, rule), "jaccard-links")
        if not good.isEmpty():
            held_so_far = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
            roots = saved(components(good.unionAll(held_so_far)), "jaccard-roots")
        if todo is not None and todo.isEmpty():
            return roots
        bad = maybe.join(good, ["a", "b"], "left_anti")
        refuted = saved(bad if refuted is None else bad.unionAll(refuted), "jaccard-refuted")
        placed = inside.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        sizes = roots.groupBy("root").agg((F.count("*") + 1).alias("size")).where(F.col("size") >= large).select(
            "root", F.lit(True).alias("large"))
        asked = placed.withColumn("todo", F.lit(True)) if todo is None else placed.join(
            todo.withColumn("todo", F.lit(True)), "node", "left").withColumn("todo", F.coalesce("todo", F.lit(False)))
        nodes = saved(asked.join(sizes, "root", "left").withColumn("large", F.coalesce("large", F.lit(False))), "jaccard-nodes")
        open_ = members if todo is None else members.join(
            members.join(todo, "node", "left_semi").select("file", "band").distinct(), ["file", "band"], "left_semi")
        tiles = _file_tiles(open_, nodes, tile_rows).unionByName(_component_tiles(open_, nodes, tile_rows))
        others = refuted.groupBy(F.col("a").alias("node")).agg(F.collect_list("b").alias("refuted"))
        seen = nodes.select("node", "n", "root", "todo", "bits").join(others, "node", "left")
        handed = saved(_tile_pairs(tiles.join(seen.hint("merge"), "node"), rule, most).distinct(), "jaccard-handed")
        maybe = handed.where("b >= 0")
        todo = saved(handed.where("b < 0").select(F.col("a").alias("node")), "jaccard-todo")
        most *= 4


def near_groups(rows: DataFrame, row: str, text: str = "text", rule: Rule | None = None, tile_rows: int = TILE_ROWS,
                large: int = LARGE, known: DataFrame | None = None) -> DataFrame:
    """``(row, n_shingles, root)`` for each row of ``rows``, whose ``row`` is unique and stays the same when read again.

    ``known`` are pairs ``(a, b)`` of rows that are held against each other first.
    """
    rule = rule or Rule()
    ship_package(rows.sparkSession)
    hashed, found = classes(rows, row, text, rule)
    if known is not None:
        node_of = lambda side: hashed.select(F.col("row").alias(side), "key").join(
            found.select("key", "node"), "key").select(side, F.col("node").alias(f"node_{side}"))
        known = known.join(node_of("a"), "a").join(node_of("b"), "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    roots = links(found, rows, row, text, rule, tile_rows, large, known)
    placed = found.select("key", "node").join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    return hashed.join(placed, "key", "left").select("row", F.col("n").alias("n_shingles"), F.coalesce("root", "row").alias("root"))


def join_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: one row per row of ``docs``; the component is its smallest id."""
    rows = saved(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                             F.monotonically_increasing_id().alias("row")), "jaccard-rows")
    groups = saved(near_groups(rows, "row", "text", rule).join(rows.select("row", "doc_id"), "row"), "jaccard-groups")
    least = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return groups.join(least, "root").select("doc_id", "n_shingles", "component_id")
