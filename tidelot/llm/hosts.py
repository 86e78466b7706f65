"""Host-level quality rules, in DataFrame functions only.

Every document is held against text rules. Failures are counted for each host, and the host's failure rate is shrunk
by a beta prior fitted to all hosts by moments. The verdict of a host goes back to its documents: documents of a
host whose rate is too high are dropped, and so is a document that fails a rule itself.

Defined results: a null text has no words and fails; a null host is a host of its own; with one host, or hosts that
do not differ, the prior is as strong as its upper limit at the overall rate; repeated rows are judged alike and each
counts; other columns are not read. An empty table gives an empty result.

Windows of eight words are compared by a 64-bit hash of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.llm.common import saved, text_of, word_list

SPAN = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
#: A document's own limits: symbols in 100 words, repeated lines in 100 lines.
MOST_SYMBOLS, MOST_DUP_LINES = 50, 50
#: A host goes when its shrunk failure rate is above this.
MOST_FAILING = 0.5
#: Limits of the prior's strength, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0


def with_counts(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """``df`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words``, prefixed."""
    p = lambda name: prefix + name
    n = F.size(p("words"))
    rows = df.withColumn(p("text"), text_of(text))
    rows = rows.withColumns({
        p("words"): word_list(F.col(p("text"))),
        p("lines"): F.filter(F.split(p("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    rows = rows.withColumn(p("hashes"), F.transform(p("words"), lambda w: F.xxhash64(w)))
    windows = F.when(n >= SPAN, F.zip_with(
        F.slice(p("hashes"), F.lit(1), n - SPAN + 1), F.sequence(F.lit(1), F.greatest(n - SPAN + 1, F.lit(1))),
        lambda _, i: F.xxhash64(F.slice(F.col(p("hashes")), i, F.lit(SPAN)))))
    rows = rows.withColumn(p("windows"), F.coalesce(windows, F.array().cast("array<long>")))
    rows = rows.withColumn(p("twice"), F.size(F.array_distinct(p("windows"))) < F.size(p("windows")))
    # Places of windows found again: sort (hash, place), keep neighbours with one hash. Only where there are any.
    placed = F.array_sort(F.transform(p("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn(p("sorted"), F.when(F.col(p("twice")), placed))
    m = F.size(p("sorted"))
    starts = F.array_sort(F.array_distinct(F.flatten(F.zip_with(
        F.slice(p("sorted"), F.lit(1), m - 1), F.slice(p("sorted"), F.lit(2), m - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))))
    rows = rows.withColumn(p("starts"), F.when(F.col(p("twice")), starts))
    k = F.size(p("starts"))
    gaps = F.zip_with(F.slice(p("starts"), F.lit(2), k - 1), F.slice(p("starts"), F.lit(1), k - 1),
                      lambda b, a: F.least(b - a, F.lit(SPAN)))
    return rows.withColumns({
        p("n_words"): n.cast("long"),
        p("word_chars"): F.aggregate(F.col(p("words")), F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        p("n_symbols"): F.regexp_count(p("text"), F.lit(r"[#*$%&|<>]")).cast("long"),
        p("n_lines"): F.size(p("lines")).cast("long"),
        p("n_dup_lines"): (F.size(p("lines")) - F.size(F.array_distinct(p("lines")))).cast("long"),
        p("n_repeat_words"): F.when(F.col(p("twice")), F.aggregate(
            gaps, F.lit(SPAN).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long")),
    }).drop(*[p(x) for x in ("text", "words", "lines", "hashes", "windows", "twice", "sorted", "starts")])


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def rule_failed(prefix: str = "") -> Column:
    """A document's own failure: the base rules, symbols, or repeated lines."""
    c = lambda name: F.col(prefix + name)
    return base_failed(prefix) | (100 * c("n_symbols") > MOST_SYMBOLS * c("n_words")) | (
        100 * c("n_dup_lines") > MOST_DUP_LINES * c("n_lines"))


def host_verdicts(counted: DataFrame, host: str = "host", failed: str = "failed", most: float = MOST_FAILING) -> DataFrame:
    """``(host, n, failures, rate, dropped)``: one row per host; ``rate`` is shrunk to the mean of all documents.

    The prior's strength follows from the spread of the rates: with mean m and the between-host variance v that is left
    after the binomial noise, it is m (1 - m) / v - 1.
    """
    hosts = counted.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("n")
    # Three numbers reach the driver, whatever the number of hosts.
    totals = hosts.agg(F.sum("failures"), F.sum("n"), F.count("*")).first()
    failures, n, count = (float(x or 0) for x in totals)
    mean = failures / n if n else 0.0
    seen = float(hosts.agg(F.sum(F.col("n") * (rate - mean) ** 2)).first()[0] or 0.0) / max(n, 1.0)
    left = seen - mean * (1 - mean) * count / max(n, 1.0)
    strength = MOST_STRENGTH if left <= 0 else min(MOST_STRENGTH, max(LEAST_STRENGTH, mean * (1 - mean) / left - 1))
    shrunk = (F.col("failures") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.withColumn("rate", shrunk).withColumn("dropped", F.col("rate") > most)


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source",
          most: float = MOST_FAILING) -> DataFrame:
    """Counts, ``base_failed``, the host's ``host_rate`` and ``kept`` for every document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("__text"))
    counted = with_counts(slim, "__text", "").drop("__text")
    counted = saved(counted.withColumn("base_failed", base_failed()).withColumn("failed", rule_failed()), "host-counts")
    hosts = host_verdicts(counted, most=most).select(F.col("host").alias("of"), F.col("rate").alias("host_rate"), "dropped")
    return counted.join(hosts, F.col("host").eqNullSafe(F.col("of"))).withColumn(
        "kept", ~F.col("failed") & ~F.col("dropped")).drop("of", "dropped", "failed")
