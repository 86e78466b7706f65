"""Near copies for the pipeline: SimHash proposes first, the exact shingle join leaves nothing out.

SimHash of five-word shingles files all texts by pigeonhole blocks and finds those whose fingerprints are equal or within two
bits (:mod:`tidelot.llm.simhash`). These pairs are held against each other first; a pair counts if the Jaccard
similarity of its five-word shingles is 0.8 or more. Two bits find most copies and few of the pairs near the border, so the
rest comes from the exact join of :mod:`tidelot.llm.jaccard` by the same rule, over what is not joined yet. Groups are the
connected components of all pairs at 0.8 or more; nothing is missed.

Defined results: ASCII letters are lower-cased, words end at ASCII white space; a text of fewer than five words is one
shingle; null, empty and blank texts are one group that is like nothing else. Only the row number and the text are read.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelot.llm import jaccard, simhash
from tidelot.llm.common import saved

RULE = jaccard.Rule(shingle=5, least=Fraction(4, 5))
#: The group of texts without words; row numbers are not negative.
BLANK = -1


def proposed(rows: DataFrame, row: str, text: str) -> DataFrame:
    """Pairs ``(a, b)`` of rows with equal or close fingerprints, a few for each row."""
    prints = saved(simhash.fingerprints(rows.select(F.col(row).cast("long").alias("row"), text), ["row"], text, RULE.shingle),
                   "near-prints")
    firsts = saved(prints.groupBy("fingerprint").agg(F.min("row").alias("first")), "near-firsts")
    equal = prints.join(firsts, "fingerprint").where("row != first").select(F.col("first").alias("a"), F.col("row").alias("b"))
    close = simhash.links(firsts.select(F.col("fingerprint").alias("f")))
    name = lambda side: firsts.select(F.col("fingerprint").alias(side), F.col("first").alias(f"row_{side}"))
    return equal.unionAll(close.join(name("a"), "a").join(name("b"), "b").select("row_a", "row_b"))


def near_groups(rows: DataFrame, row: str, text: str = "text") -> DataFrame:
    """``(row, root)`` for each row of ``rows``, whose ``row`` is unique, not negative and the same when they are read again."""
    groups = jaccard.near_groups(rows, row, text, RULE, known=proposed(rows, row, text))
    return groups.select("row", F.when(F.col("n_shingles") == 0, BLANK).otherwise(F.col("root")).alias("root"))
