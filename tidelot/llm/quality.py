"""Quality classifier: a sparse rule ensemble.

Trees are grown on text statistics, every path becomes a conjunctive rule, a lasso logistic regression weighs the
rules, and the rules with a weight left are compiled into one Spark column expression.

Defined results: a null text counts as empty; an empty text has all statistics zero and is scored like any other;
repeated rows are scored alike; without any label every score is 0.5; with labels of one class only the score is the
smoothed share of label 1. Other columns of the input are never read by the scoring.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.llm.common import all_of, label_sample, saved, text_of, word_list

STATISTICS = [
    "words", "word_length", "symbols", "bars", "exclamations", "upper", "digits", "distinct", "adjacent", "repeated_lines",
]
#: Labelled rows the forest and the lasso are fitted on, in expectation; all of them where there are fewer.
SAMPLE_ROWS = 50_000
TREES, DEPTH, LASSO = 16, 3, 0.0005


@dataclass(frozen=True)
class Rule:
    """``bounds``: (statistic, is upper bound, threshold) that must all hold."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self, statistics: dict[str, Column]) -> Column:
        return all_of([
            statistics[name] <= F.lit(edge) if upper else statistics[name] > F.lit(edge)
            for name, upper, edge in self.bounds
        ])


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, statistics: dict[str, Column]) -> Column:
        """Probability of label 1 as a column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(statistics), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def with_statistics(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """``df`` and one double column for each of :data:`STATISTICS`, named with ``prefix``."""
    whole, words, lines = f"{prefix}whole", f"{prefix}list", f"{prefix}lines"
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    chars = F.greatest(F.length(whole), F.lit(1)).cast("double")
    share = lambda pattern, of: F.regexp_count(F.col(whole), F.lit(pattern)) / of
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: a == b)
    found = {
        "words": F.size(words).cast("double"),
        "word_length": F.aggregate(F.col(words), F.lit(0), lambda a, w: a + F.length(w)) / n,
        "symbols": share(r"[#*$%&<>]", n),
        "bars": share(r"\|", n),
        "exclamations": share("!", n),
        "upper": share(r"\p{Lu}", chars),
        "digits": share("[0-9]", chars),
        "distinct": F.size(F.array_distinct(words)) / n,
        "adjacent": F.size(F.filter(pairs, lambda same: same)) / n,
        "repeated_lines": 1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
    }
    return (
        df.withColumn(whole, text_of(text))
        .withColumns({words: word_list(F.col(whole)), lines: F.filter(F.split(whole, "\n"), lambda x: F.trim(x) != "")})
        .withColumns({f"{prefix}{k}": v.cast("double") for k, v in found.items()})
        .drop(whole, words, lines)
    )


def _paths(node, names: list[str], bounds: dict) -> list[Rule]:
    """Every non-root node of a fitted tree as a rule; bounds on one statistic are merged."""
    if not node.getClass().getSimpleName().startswith("Internal"):
        return []
    split, found = node.split(), []
    name, edge = names[split.featureIndex()], float(split.threshold())
    for upper, child in ((True, node.leftChild()), (False, node.rightChild())):
        old = bounds.get((name, upper))
        tight = edge if old is None else (min if upper else max)(old, edge)
        inner = bounds | {(name, upper): tight}
        found.append(Rule(tuple(sorted((k[0], k[1], v) for k, v in inner.items()))))
        found += _paths(child, names, inner)
    return found


def grow_rules(sample: DataFrame, names: list[str]) -> list[Rule]:
    """Distinct conjunctive rules from the paths of a forest on ``sample`` (statistics and ``label``)."""
    frame = VectorAssembler(inputCols=names, outputCol="features").transform(sample).select("features", "label")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=3, featureSubsetStrategy="0.5", seed=11,
    ).fit(frame)
    rules: dict[Rule, None] = {}
    for tree in forest.trees:
        rules |= dict.fromkeys(_paths(tree._call_java("rootNode"), names, {}))
    return list(rules)


def fit(labelled: DataFrame, names: list[str] = STATISTICS) -> RuleModel:
    """Fit on statistics and a 0/1 ``label``."""
    sample = labelled.select(*names, "label").persist()
    counts = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        sample.unpersist()
        share = (counts.get(1.0, 0) + 0.5) / (total + 1) if total else 0.5
        return RuleModel(math.log(share / (1 - share)), ())
    try:
        rules = grow_rules(sample, names)
        if not rules:
            share = counts[1.0] / total
            return RuleModel(math.log(share / (1 - share)), ())
        statistics = {name: F.col(name) for name in names}
        held = F.array(*[rule.column(statistics).cast("double") for rule in rules])
        lasso = LogisticRegression(
            elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60, tol=1e-5,
        ).fit(sample.select(array_to_vector(held).alias("features"), "label"))
        weights = [float(x) for x in lasso.coefficients.toArray()]
        return RuleModel(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w != 0.0))
    finally:
        sample.unpersist()


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          allowed: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on about ``sample_rows`` labelled documents; ``allowed`` is a condition on the id column ``key``."""
    rows = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text")).join(
        label_sample(labels, label, sample_rows, doc_id, allowed), "key")
    return fit(saved(with_statistics(rows, "text", "").drop("text"), "quality-train"))


def score(df: DataFrame, model: RuleModel, text: str = "text", prefix: str = "__quality_") -> DataFrame:
    """``df`` and ``{prefix}score``."""
    full = with_statistics(df, text, prefix)
    statistics = {name: F.col(prefix + name) for name in STATISTICS}
    return full.withColumn(f"{prefix}score", model.score(statistics)).drop(*[prefix + name for name in STATISTICS])
