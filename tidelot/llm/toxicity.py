"""Toxicity: maximum-scoring segments over token log-odds.

A token's score is its log-odds between toxic and clean documents under an informative Dirichlet prior; tokens
without a clear positive log-odds cost a constant. A linear scan finds all disjoint maximal segments. Their scores
are calibrated by extreme-value statistics (decay of the clean token scores, expected number of chance segments), the
sum statistic joins the segments of a document, and a logistic curve turns the significance into a probability.

Defined results: a null text counts as empty; texts without tokens have no segment and get the score of no evidence;
repeated rows are scored alike; without labels, or with one class only, the lexicon is empty and the score is the
smoothed share of label 1. Other columns of the input are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.llm.common import label_sample, saved, ship_package, text_of

TOKEN = re.compile(r"[^\W\d_]+")
#: Prior mass as a share of the corpus; least z and least log-odds of a lexicon entry; score of any other token.
PRIOR, LEAST_Z, LEAST_LOG_ODDS, OTHER = 0.1, 2.5, 1.0, -0.25
#: Size of the model: the clearest entries are kept.
LEXICON_ENTRIES = 20_000
#: Labelled documents that are learned from, in expectation; all of them where there are fewer.
SAMPLE_ROWS = 100_000
#: Distinct tokens a task holds before it hands its counts on; all counts are summed later.
HELD_TOKENS = 200_000
#: Significance above which segments are reported.
LEAST_SIGNIFICANCE = 1.0


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def token_counts(labelled: DataFrame) -> DataFrame:
    """``(token, toxic, clean)``: labelled documents of each kind with the token; from ``(text, label)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def out() -> pa.RecordBatch:
            names = list(toxic.keys() | clean.keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()),
                 pa.array([clean[x] for x in names], pa.int64())], ["token", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                (toxic if label.as_py() >= 0.5 else clean).update(set(tokens(text.as_py())))
                if len(toxic) + len(clean) > HELD_TOKENS:
                    yield out()
                    toxic.clear()
                    clean.clear()
        yield out()

    held = labelled.select(text_of("text").alias("text"), "label")
    return held.mapInArrow(count, "token string, toxic long, clean long").groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame, prior: float = PRIOR) -> DataFrame:
    """``counts`` with ``log_odds`` and ``z`` under a Dirichlet prior proportional to the corpus."""
    all_toxic, all_clean = (counts.agg(F.sum("toxic"), F.sum("clean")).first() or (0, 0))
    all_toxic, all_clean = float(all_toxic or 0), float(all_clean or 0)
    mass = prior * (all_toxic + all_clean)
    a = prior * (F.col("toxic") + F.col("clean"))
    odds = lambda n, total: F.log((n + a) / (F.lit(total + mass) - n - a))
    return counts.withColumns({
        "log_odds": odds(F.col("toxic"), all_toxic) - odds(F.col("clean"), all_clean),
        "deviation": F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a)),
    }).withColumn("z", F.col("log_odds") / F.col("deviation")).drop("deviation")


def lexicon_of(counts: DataFrame, entries: int = LEXICON_ENTRIES) -> dict[str, float]:
    """Clearly toxic tokens with their log-odds; empty where one kind of document is missing."""
    clear = log_odds(counts).where((F.col("z") >= LEAST_Z) & (F.col("log_odds") >= LEAST_LOG_ODDS))
    best = clear.orderBy(F.desc("z"), "token").limit(entries).collect()
    return {row["token"]: float(row["log_odds"]) for row in best}


def maximal_segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All disjoint maximal segments ``(first, last, score)`` of a sequence that is ``other`` outside ``hits``.

    ``hits`` are (position, positive score) in order. Candidates are kept with the cumulated score at their left and
    right and the place of the last earlier candidate with a smaller left, so that no candidate is looked at in vain
    twice; a new one swallows those it dominates. The scan is linear.
    """
    stack: list[tuple[int, int, float, float, int]] = []
    total, seen = 0.0, -1
    for at, score in hits:
        total += other * (at - seen - 1)
        left, first = total, at
        total += score
        seen = at
        k = len(stack) - 1
        while True:
            while k >= 0 and stack[k][2] >= left:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= total:
                break
            first, _, left, _, before = stack[k]
            del stack[k:]
            k = before
        stack.append((first, at, left, total, k))
    return [(a, b, right - left) for a, b, left, right, _ in stack]


def scan(docs: DataFrame, lexicon: dict[str, float], other: float = OTHER, keep: list[str] = ("key",)) -> DataFrame:
    """``keep``, ``n_tokens`` and ``segments`` (character start, end, score) for each row's ``text``."""
    schema = ", ".join(f"{c} {t}" for c, t in docs.select(*keep).dtypes)
    schema += ", n_tokens long, segments array<struct<start:long, stop:long, score:double>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        score = known.get
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(len(keep)):
                text = text.as_py()
                # Lower-casing may change the length of a text, so places are those of the original tokens.
                words = tokens(text)
                hits = [(i, s) for i, s in enumerate(map(score, words)) if s is not None]
                sizes.append(len(words))
                found.append(_placed(text, words, maximal_segments(hits, other)) if hits else [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(sizes, pa.int64()), pa.array(found, kind)],
                [*keep, "n_tokens", "segments"])

    return docs.select(*keep, text_of("text").alias("__text")).mapInArrow(find, schema)


def _placed(text: str, words: list[str], segments: list[tuple[int, int, float]]) -> list[dict]:
    """Token places as code points of the text."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    if len(spans) != len(words):  # a letter whose lower case holds other marks: take the places in the lower case
        spans = [m.span() for m in TOKEN.finditer(text.lower())]
    return [{"start": spans[a][0], "stop": spans[b][1], "score": s} for a, b, s in segments]


@dataclass(frozen=True)
class Calibration:
    """Chance segments: ``log_k`` and ``decay``; probability of label 1: logistic in the significance."""

    decay: float
    log_k: float
    slope: float
    intercept: float

    def significance(self, n_tokens: Column, scores: Column) -> Column:
        """-log10 of the sum statistic's chance, the least over the best 1, 2, ... segments; 0 without segments."""
        size = F.log(F.greatest(n_tokens.cast("double"), F.lit(1.0))) + F.lit(self.log_k)
        best = F.reverse(F.array_sort(scores))
        start = F.struct(F.lit(0).alias("r"), F.lit(0.0).alias("t"), F.lit(0.0).alias("logs"), F.lit(0.0).alias("best"))

        def step(acc: Column, s: Column) -> Column:
            r = acc["r"] + 1
            t = acc["t"] + F.lit(self.decay) * s - size
            logs = acc["logs"] + F.when(r > 1, F.log(r.cast("double")) + F.log((r - 1).cast("double"))).otherwise(F.lit(0.0))
            chance = -t + (r - 1) * F.log(F.greatest(t, F.lit(1.0))) - logs
            return F.struct(r.alias("r"), t.alias("t"), logs.alias("logs"),
                            F.greatest(acc["best"], -chance / math.log(10)).alias("best"))

        return F.aggregate(best, start, step, lambda acc: acc["best"])

    def probability(self, significance: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.intercept) + F.lit(self.slope) * significance)))


def decay_of(lexicon: dict[str, float], clean_hits: dict[str, int], clean_tokens: int, other: float = OTHER) -> float:
    """The positive root of sum p(s) exp(decay s) = 1 over the clean token scores; one pseudo-hit keeps it finite."""
    n = max(clean_tokens, 1) + 1.0
    scored = [(lexicon[w], c / n) for w, c in clean_hits.items()] + [(max(lexicon.values(), default=1.0), 1 / n)]
    rest = max(1e-9, 1 - sum(p for _, p in scored))
    value = lambda x: sum(p * math.exp(min(700.0, x * s)) for s, p in scored) + rest * math.exp(x * other) - 1
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def fit_logistic(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Slope (not negative) and intercept for (significance, positives, rows) by Newton steps with a weak prior."""
    slope, intercept = 0.0, 0.0
    for _ in range(60):
        g0, g1, h00, h01, h11 = -1e-3 * intercept, -1e-3 * slope, 1e-3, 0.0, 1e-3
        for x, positive, rows in bins:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, intercept + slope * x))))
            w = rows * p * (1 - p)
            g0, g1 = g0 + positive - rows * p, g1 + (positive - rows * p) * x
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        det = h00 * h11 - h01 * h01
        if det <= 0:
            break
        d0, d1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = min(1.0, 4.0 / max(abs(d0), abs(d1), 1e-12))
        intercept, slope = intercept + scale * d0, slope + scale * d1
        if abs(d0) + abs(d1) < 1e-9:
            break
    return max(slope, 0.0), intercept


#: Significance is gathered into bins of this width, up to the last one, for the logistic curve.
BIN, LAST_BIN = 0.25, 200


def calibrate(scanned: DataFrame, counts: DataFrame, lexicon: dict[str, float], other: float = OTHER) -> Calibration:
    """From scanned labelled rows (``n_tokens``, ``segments``, ``label``) and the token counts."""
    clean = scanned.where("label < 0.5").agg(
        F.sum("n_tokens").alias("n"), F.sum(F.size("segments")).alias("found")).first()
    n_clean, found = int(clean["n"] or 0), int(clean["found"] or 0)
    spark = scanned.sparkSession
    words = spark.createDataFrame([(w,) for w in lexicon], "token string")  # at most LEXICON_ENTRIES rows
    hits = {r["token"]: r["clean"] for r in counts.join(F.broadcast(words), "token").select("token", "clean").collect()}
    decay = decay_of(lexicon, hits, n_clean, other)
    least = min(lexicon.values(), default=1.0)
    log_k = min(0.0, math.log((found + 0.5) / max(n_clean, 1)) + decay * least)
    chance = Calibration(decay, log_k, 0.0, 0.0)
    value = chance.significance(F.col("n_tokens"), F.transform("segments", lambda s: s["score"]))
    bins = scanned.groupBy(F.least(F.floor(value / BIN), F.lit(LAST_BIN)).alias("bin")).agg(
        F.sum("label").alias("positive"), F.count("*").alias("rows")).collect()
    slope, intercept = fit_logistic([((r["bin"] + 0.5) * BIN, r["positive"], r["rows"]) for r in bins])
    return Calibration(decay, log_k, slope, intercept)


def detect(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
           allowed: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``key`` (the id), ``score``, ``significance``, ``n_tokens`` and ``segments``.

    ``segments`` holds every maximal toxic passage. Token counts and calibration are taken from about ``sample_rows``
    labelled documents; ``allowed`` is a condition on the id column ``key``.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    answers = label_sample(labels, label, sample_rows, doc_id, allowed)
    counts = saved(token_counts(rows.join(answers, "key")), "toxic-counts")
    lexicon = lexicon_of(counts)
    scanned = saved(scan(rows, lexicon, keep=["key"]), "toxic-scan")
    calibration = calibrate(scanned.join(answers, "key"), counts, lexicon)
    value = calibration.significance(F.col("n_tokens"), F.transform("segments", lambda s: s["score"]))
    return scanned.withColumn("significance", value).select(
        "key", calibration.probability(F.col("significance")).alias("score"), "significance", "n_tokens", "segments")
