"""Spelling variants of one vocabulary, found through Bloom-guided neighbourhoods.

Words are counted over all texts. A word's edits are generated and probed against Bloom filters of the vocabulary, one
filter a word length, that every task holds; only edits that a filter does not rule out are shuffled, to an exact join with
the vocabulary that removes what was let through wrongly. An insertion is a deletion seen from the longer word and a
replacement is found from both sides, so deletions and replacements by a larger letter are all that has to be probed; each
pair found counts for both words.

Filters are split blocks: a word sets one bit in each of eight 32-bit lanes of one block. Words are hashed place by place
(the exclusive or of a hash of each place and letter), so that the hash of an edit follows from its word's in one step. At most
:data:`FILTER_WORDS` words are in the filters that are sent at a time: a larger vocabulary is probed in several passes, by length
and, where one length alone has more, by a hash of the word, so what is sent stays bounded and the rate of wrong hits with it.

A word's form is its near word of largest count, if that is at least twice the word's own; roots follow the forms by
pointer doubling, at most a logarithm of the logarithm of the largest count in rounds.

Defined results: a null or empty text has no word; a null doc_id is the empty text in the digest that decides on deletions;
repeated rows count as often as they occur; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelot.llm.common import saved, ship_package, text_of

LEAST_LENGTH, LEAST_COUNT, DROP_ONE_IN = 5, 3, 97
#: A form occurs at least so many times as often as its variant.
MUCH_MORE = 2
#: Words in the filters of one pass, bits a word, and words counted in a task before they are handed on.
FILTER_WORDS, BITS_A_WORD, COUNTED_WORDS = 4_000_000, 16, 200_000
LANES = 8
_EDITS = 1 << 20

#: Letters are one byte each in Latin-1; everything else is a blank. Only ASCII letters are lowered.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: What words are made of after that, in order.
LETTERS = np.array([b for b in range(256) if 97 <= b <= 122 or b >= 0xC0], np.uint8)


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters, ASCII ones lowered, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_FOLDED).split()


def damaged(head: int, run: bytes) -> bytes:
    """The run as it is counted: one letter goes where the digest is divisible by 97; ``head`` is that of ``<doc_id>:``."""
    digest = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode("utf-8"), head)
    if digest % DROP_ONE_IN:
        return run
    at = digest % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: words of at least five letters that occur at least three times."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            whole = {w: n for w, n in counts.items() if len(w) >= LEAST_LENGTH}
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in whole], pa.string()), pa.array(list(whole.values()), pa.int64())],
                ["word", "n"])

        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                head = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(runs(content)).items():
                    counts[damaged(head, run)] += n
                if len(counts) >= COUNTED_WORDS:
                    yield out()
        yield out()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), text_of(text).alias("t"))
    return rows.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- Hashes and filters --------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wrap-around is meant."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place_hash(places: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Hash of a letter at a place."""
    return _mixed((places.astype(np.uint64) << np.uint64(8)) + letters.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def word_hashes(words: np.ndarray) -> np.ndarray:
    """One hash a row of a table of letters: the exclusive or over places."""
    if not words.shape[1]:
        return np.zeros(len(words), np.uint64)
    return np.bitwise_xor.reduce(place_hash(np.arange(words.shape[1])[None, :], words), axis=1)


def _bits(hashes: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash and its bit in every lane."""
    hashes = _mixed(hashes)
    block = ((hashes >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)
    lanes = (_mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93))[:, None] >> (np.arange(LANES) * 5).astype(np.uint64)) & np.uint64(31)
    return block.astype(np.int64), np.uint32(1) << lanes.astype(np.uint32)


def blocks_for(words: int) -> int:
    return max(1, -(-words * BITS_A_WORD // (LANES * 32)))


class Filters:
    """Bloom filters by word length."""

    def __init__(self, words: dict[int, int]) -> None:
        self.lanes = {length: np.zeros((blocks_for(n), LANES), np.uint32) for length, n in words.items()}

    def may_hold(self, length: int, hashes: np.ndarray) -> np.ndarray:
        lanes = self.lanes[length]
        block, bits = _bits(hashes, len(lanes))
        return ((lanes[block] & bits) == bits).all(axis=1)


def _tables(words: list[bytes]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """Words by length: length, their places in the list and a table of letters."""
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, places in by_length.items():
        yield length, places, np.frombuffer(b"".join(words[i] for i in places), np.uint8).reshape(len(places), length)


def build_filters(spark: SparkSession, words: DataFrame, sizes: dict[int, int]) -> Filters:
    """Filters of ``words (word, length)``; Spark sets the bits, and no more than the bounded filters reach the driver."""
    counts = dict(sizes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, table in _tables([w.encode("latin-1") for w in batch.column(0).to_pylist()]):
                block, bits = _bits(word_hashes(table), blocks_for(counts[length]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(block.size * LANES, length, np.int32)),
                     pa.array((block[:, None] * LANES + np.arange(LANES)).ravel()),
                     pa.array(bits.ravel().astype(np.int64))], ["length", "lane", "bits"])

    set_bits = words.select("word").mapInArrow(work, "length int, lane long, bits long").groupBy("length", "lane").agg(
        F.bit_or("bits").alias("bits"))
    filters = Filters(counts)
    table = set_bits.toArrow()
    lengths, lanes, bits = (table.column(c).to_numpy() for c in ("length", "lane", "bits"))
    for length, flat in filters.lanes.items():
        mine = lengths == length
        flat.reshape(-1)[lanes[mine]] = bits[mine].astype(np.uint32)
    return filters


# --- Edits -----------------------------------------------------------------------


def edits(length: int, table: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``table`` and their edits, as letters, that a filter does not rule out."""
    places = np.arange(length)
    here = place_hash(places[None, :], table)
    whole = np.bitwise_xor.reduce(here, axis=1)
    if length - 1 in filters.lanes:
        shifted = place_hash(np.maximum(places - 1, 0)[None, :], table)  # a letter behind the deleted one moves forward
        before = np.bitwise_xor.accumulate(here, axis=1) ^ here
        after = np.bitwise_xor.accumulate(shifted[:, ::-1], axis=1)[:, ::-1] ^ shifted
        # Deleting either of two equal neighbours gives one word.
        distinct = np.concatenate([np.ones((len(table), 1), bool), table[:, 1:] != table[:, :-1]], axis=1)
        rows, at = np.nonzero(distinct)
        found = filters.may_hold(length - 1, (before ^ after)[rows, at])
        rows, at = rows[found], at[found]
        kept = np.arange(length - 1)[None, :]
        yield rows, table[rows[:, None], kept + (kept >= at[:, None])]
    if length in filters.lanes:
        for place in range(length):
            rows, letter = np.nonzero(LETTERS[None, :] > table[:, place, None])
            hashes = whole[rows] ^ here[rows, place] ^ place_hash(np.array([place]), LETTERS)[letter]
            found = filters.may_hold(length, hashes)
            changed = table[rows[found]]
            changed[:, place] = LETTERS[letter[found]]
            yield rows[found], changed


def candidates(words: DataFrame, sent: Broadcast) -> DataFrame:
    """``(word, other)``: edits of ``words (word)`` that may be words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: Filters = sent.value
        for batch in batches:
            spelled = batch.column(0).to_pylist()
            for length, places, table in _tables([w.encode("latin-1") for w in spelled]):
                if length not in filters.lanes and length - 1 not in filters.lanes:
                    continue
                step = max(1, _EDITS // (length * max(length, len(LETTERS))))
                for low in range(0, len(table), step):
                    for rows, letters in edits(length, table[low: low + step], filters):
                        if len(rows):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([spelled[places[low + i]] for i in rows.tolist()], pa.string()),
                                 pa.array([x.tobytes().decode("latin-1") for x in letters], pa.string())], ["word", "other"])

    return words.select("word").mapInArrow(work, "word string, other string")


def passes(sizes: dict[int, int], most: int = FILTER_WORDS) -> list[dict[int, tuple[int, int]]]:
    """What each pass puts into its filters: by length, ``(shard, shards)`` of that length's words."""
    out: list[dict[int, tuple[int, int]]] = []
    room = 0
    for length in sorted(sizes):
        shards = -(-sizes[length] // most)
        if shards > 1:
            out += [{length: (i, shards)} for i in range(shards)]
            room = 0
        elif sizes[length] <= room:
            out[-1][length] = (0, 1)
            room -= sizes[length]
        else:
            out.append({length: (0, 1)})
            room = most - sizes[length]
    return out


def near_pairs(words: DataFrame, most: int = FILTER_WORDS) -> DataFrame:
    """``(word, other, other_n)`` for all near words, in both directions; ``words (word, n)`` hold each word once."""
    spark = words.sparkSession
    sized = words.withColumn("length", F.length("word"))
    # One row a length; words too long for anyone to spell are few, so are their lengths.
    sizes = {r["length"]: r["n"] for r in sized.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = []
    for part in passes(sizes, most):
        inside = [(F.col("length") == length) & (F.pmod(F.xxhash64("word"), F.lit(shards)) == shard)
                  for length, (shard, shards) in part.items()]
        held = sized.where(reduce(lambda a, b: a | b, inside))
        # Shards of one length differ by chance; a filter a little fuller or emptier is as right.
        filters = build_filters(spark, held, {length: -(-sizes[length] // n) for length, (_, n) in part.items()})
        asked = sized.where(F.col("length").isin([x for length in part for x in (length, length + 1)]))
        found.append(candidates(asked, spark.sparkContext.broadcast(filters)))
    maybe = saved(reduce(DataFrame.unionAll, found).distinct(), "spelling-edits")
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    one = saved(maybe.join(known, "other").join(words, "word").select("word", "n", "other", "other_n"), "spelling-near")
    return one.select("word", "other", "other_n").unionAll(
        one.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``forms (word, form)``, each word once: the end of the chain of forms."""
    now = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = saved(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                             F.col("further").isNotNull().alias("moved")), "spelling-roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = FILTER_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``: one row a word."""
    ship_package(docs.sparkSession)
    words = saved(vocabulary(docs, doc_id, text), "spelling-words")
    if words.isEmpty():
        return docs.sparkSession.createDataFrame([], "word string, form string, root string, n long, n_near long, form_n long")
    nearest = near_pairs(words, most).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = words.join(nearest, "word", "left")
    most_n = -F.col("best.less")
    ready = saved(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(most_n >= MUCH_MORE * F.col("n"), F.col("best.other")).alias("form"),
        F.when(most_n >= MUCH_MORE * F.col("n"), most_n).alias("form_n")), "spelling-forms")
    ends = roots(ready.where("form is not null").select("word", "form"))
    return ready.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
