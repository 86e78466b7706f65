"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the spans of the base patterns and wider ones (long numbers, account codes). Five labelers vote on each:
structure (checksums, ranges), gazetteers (top-level domains, issuer digits, calling codes, countries), the words
before, the shape of the grouping, and what touches the span. Expectation-maximisation over the counted vote patterns
estimates how reliable each labeler is; its posteriors train a logistic span classifier on discrete features, which
becomes a column expression. Base spans always stay; other candidates are reported where the classifier agrees.

Only counts of vote patterns (3^5 at most) and of feature combinations (:data:`COMBINATIONS` at most) reach the driver.

Defined results: a null text is empty; an empty text has no spans and the digest of the empty string; places are code
points, ends are exclusive; repeated rows are treated alike; without candidates no classifier is fitted and only base
spans are reported; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.llm.common import saved, text_of

KINDS = ["email", "ip", "card", "phone", "number", "iban"]
BASE = 4
# Possessive quantifiers never go back, so long runs cost linear time and no stack; a run can only match from its first
# character on, hence the look-behinds. After an email the next may begin at once, inside a run.
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
NUMBER = r"[0-9](?:[\x20-]?[0-9]){8,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Gazetteers and cue words.
TOP_DOMAINS = "com|org|net|edu|gov|io|de|fr|es|uk|eu|info"
COUNTRIES = "AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PL|PT|SE"
CALLING_CODES = r"\+(?:1|33|34|39|41|43|44|49)(?![0-9]{12})"
CUES = "phone|tel|call|mobile|fax|mail|e-mail|contact|card|visa|account|konto|iban|ssn|passport|member|cuenta|compte"
ANTI_CUES = "isbn|issn|doi|token|hash|sha|md5|version|order|page|line|serial|commit"

# Length of an account code by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU"}
_SIZED = "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, c in IBAN_LENGTHS.items())
_SIZED = rf"(?:{_SIZED})(?![A-Za-z0-9])"
# By the country's length; else the longest run that ends with a word, up to where a code of known length begins.
IBAN = rf"(?<![A-Za-z0-9])(?:{_SIZED}|[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20{_SIZED})\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))"

FEATURES = ["kind", "size", "groups", "before", "after", "lead"]
COMBINATIONS = len(KINDS) * 8 * 4 * 4 * 3 * 3
LABELERS = ["structure", "gazetteer", "context", "shape", "touch"]


def _found(text: Column, matches: Column, pattern: str) -> Column:
    """Array of (start, stop, m, before, after): places follow from the lengths of the pieces between the matches."""
    between = F.split(text, pattern, -1)
    n = F.size(matches)
    steps = F.zip_with(F.zip_with(F.slice(between, F.lit(1), n), F.slice(between, F.lit(2), n),
                                  lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                       matches, lambda g, m: F.struct(g["a"].alias("a"), g["b"].alias("b"), m.alias("m")))
    kind = "array<struct<start:long,stop:long,m:string,before:string,after:string>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        left = acc["at"] + F.length(x["a"])
        right = left + F.length(x["m"])
        one = F.struct(left.alias("start"), right.alias("stop"), x["m"].alias("m"), F.right(x["a"], F.lit(24)).alias("before"),
                       F.left(x["b"], F.lit(4)).alias("after"))
        return F.struct(right.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.when(n > 0, F.aggregate(steps, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(kind))


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits, two or more, passes the Luhn check."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def iban_valid(m: Column) -> Column:
    """Remainder one modulo 97, letters as 10 to 35, the first four characters moved to the end."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4)))

    def add(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, acc * 10 + c - 48).otherwise(acc * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _as(kind: int, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["stop"].alias("stop"), s["m"].alias("m"),
        s["before"].alias("before"), s["after"].alias("after")))


def _apart(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["stop"]) & (s["start"] < o["stop"])))


def with_candidates(df: DataFrame, text: str, prefix: str = "__pii_") -> DataFrame:
    """``df`` with the arrays ``{prefix}base`` and ``{prefix}wide`` of (start, kind, stop, m, before, after), sorted."""
    p = lambda name: prefix + name
    none = F.array().cast("array<string>")
    whole = F.col(p("text"))
    all_of = lambda pattern: F.regexp_extract_all(p("text"), F.lit(pattern), 0)
    rows = df.withColumn(p("text"), text_of(text)).withColumns({
        p("m0"): F.when(whole.contains("@"), all_of(EMAIL)).otherwise(none),
        p("m1"): all_of(IP),
        p("m2"): all_of(NUMBER),
        p("m3"): F.when(whole.contains("+"), all_of(PHONE)).otherwise(none),
        p("m5"): all_of(IBAN),
    }).withColumns({
        p(f"s{i}"): _found(whole, F.col(p(f"m{i}")), pattern)
        for i, pattern in ((0, EMAIL), (1, IP), (2, NUMBER), (3, PHONE), (5, IBAN))
    })
    size = lambda s: F.length(digits_of(s["m"]))
    base = F.concat(
        _as(0, F.col(p("s0"))),
        _as(1, F.filter(p("s1"), lambda s: s["m"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))),
        _as(2, F.filter(p("s2"), lambda s: F.when(size(s).between(12, 19), luhn(digits_of(s["m"]))).otherwise(F.lit(False)))),
        _as(3, F.filter(p("s3"), lambda s: size(s).between(9, 15))),
    )
    rows = rows.withColumn(p("base"), F.array_sort(base))
    wide = F.concat(_as(4, _apart(F.col(p("s2")), F.col(p("base")))), _as(5, _apart(F.col(p("s5")), F.col(p("base")))))
    return rows.withColumn(p("wide"), F.array_sort(wide)).drop(
        p("text"), *[p(f"{a}{i}") for a in "ms" for i in (0, 1, 2, 3, 5)])


def votes(s: Column) -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1 personal, -1 not, 0 no opinion."""
    kind, m = s["kind"], s["m"]
    n = F.length(digits_of(m))
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    structure = (
        F.when(kind < BASE, yes)
        .when(kind == 5, F.when(iban_valid(m), yes).otherwise(no))
        .when(n.isin(9, 16), none).otherwise(no))
    gazetteer = (
        F.when(kind == 0, F.when(m.rlike(rf"(?i)\.(?:{TOP_DOMAINS})$"), yes).otherwise(none))
        .when(kind.isin(2, 4), F.when((n == 16) & m.rlike("^[3-6]"), yes).otherwise(none))
        .when(kind == 3, F.when(m.rlike(f"^{CALLING_CODES}"), yes).otherwise(none))
        .when(kind == 5, F.when(m.rlike(f"^(?:{COUNTRIES})"), yes).otherwise(no))
        .otherwise(none))
    context = (
        F.when(s["before"].rlike(rf"(?i)\b(?:{ANTI_CUES})\b[^\p{{L}}]*$"), no)
        .when(s["before"].rlike(rf"(?i)\b(?:{CUES})\b[^\p{{L}}]*$"), yes).otherwise(none))
    shape = (
        F.when(m.rlike("^[0-9]{4}([ -]?)[0-9]{4}\\1[0-9]{4}\\1[0-9]{4}$") | m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), yes)
        .when(kind.isin(2, 4) & ((n > 19) | m.rlike("[ -][0-9]?$|^[0-9][ -]")), no)
        .when(kind == 3, F.when(m.rlike(r"^\+[0-9]{1,3}[ -]?\(?[0-9]+\)?[ -]"), yes).otherwise(none))
        .otherwise(none))
    touch = F.when(s["before"].rlike(r"[\p{L}0-9_=/.#-]$") | s["after"].rlike(r"^[\p{L}0-9_=/@#-]"), no).otherwise(none)
    return dict(zip(LABELERS, (structure, gazetteer, context, shape, touch), strict=True))


def features(s: Column) -> dict[str, Column]:
    """Discrete features of a candidate; every one has few values."""
    m, before, after = s["m"], s["before"], s["after"]
    n = F.length(digits_of(m))
    char = lambda x, pattern, value: F.when(x.rlike(pattern), F.lit(value))
    return {
        "kind": s["kind"],
        "size": F.when(n < 9, 0).when(n == 9, 1).when(n < 12, 2).when(n < 15, 3).when(n == 15, 4).when(n == 16, 5).when(
            n < 20, 6).otherwise(7),
        "groups": F.least(F.length(F.regexp_replace(m, "[^ ().-]", "")), F.lit(3)),
        "before": char(before, rf"(?i)\b(?:{CUES})\b[^\p{{L}}]*$", 1).when(
            before.rlike(rf"(?i)\b(?:{ANTI_CUES})\b[^\p{{L}}]*$"), 2).when(before.rlike(r"[\p{L}0-9_=/.#-]$"), 3).otherwise(0),
        "after": char(after, r"^[\p{L}0-9_]", 1).when(after.rlike(r"^[=/@#-]"), 2).otherwise(0),
        "lead": char(m, "^[3-6]", 1).when(m.rlike("^[A-Za-z+]"), 2).otherwise(0),
    }


@dataclass(frozen=True)
class Reliability:
    """Result of expectation-maximisation: share of personal candidates, P(vote | class) and posteriors by pattern."""

    share: float
    given: dict[tuple[int, int, int], float]
    posterior: dict[tuple[int, ...], float] = field(repr=False)


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 100) -> Reliability:
    """Two-class model with independent labelers, begun from the majority of the votes. Classes: 1 personal, 0 not."""
    width = len(LABELERS)
    post = {v: 0.9 if sum(v) > 0 else 0.1 if sum(v) < 0 else 0.5 for v in patterns}
    share, given = 0.5, {}
    for _ in range(rounds):
        total = sum(patterns.values())
        share = (sum(n * post[v] for v, n in patterns.items()) + 1) / (total + 2)
        for c in (0, 1):
            weight = {v: n * (post[v] if c else 1 - post[v]) for v, n in patterns.items()}
            mass = sum(weight.values())
            for j in range(width):
                for vote in (-1, 0, 1):
                    # The pseudo-counts say that labelers are better than chance, which also names the classes.
                    hint = 1.0 + 2.0 * (vote == (1 if c else -1))
                    given[c, j, vote] = (sum(w for v, w in weight.items() if v[j] == vote) + hint) / (mass + 5.0)
        new = {}
        for v in patterns:
            logs = [math.log(share if c else 1 - share) + sum(math.log(given[c, j, v[j]]) for j in range(width)) for c in (0, 1)]
            new[v] = 1 / (1 + math.exp(max(-700.0, min(700.0, logs[0] - logs[1]))))
        moved = max(abs(new[v] - post[v]) for v in patterns)
        post = new
        if moved < 1e-9:
            break
    return Reliability(share, given, post)


@dataclass(frozen=True)
class SpanModel:
    """Logistic weights by (feature, value)."""

    intercept: float
    weights: dict[tuple[str, int], float]

    def score(self, s: Column) -> Column:
        total = F.lit(self.intercept)
        for name, column in features(s).items():
            part = F.lit(0.0)
            for (of, value), w in sorted(self.weights.items()):
                if of == name:
                    part = F.when(column == value, F.lit(w)).otherwise(part)
            total = total + part
        return 1 / (1 + F.exp(-total))


def train_spans(combinations: list[tuple[tuple[int, ...], float, float]], rounds: int = 400, ridge: float = 1.0) -> SpanModel:
    """Fit on (feature values, rows, sum of posteriors) by gradient steps with a ridge penalty."""
    names = sorted({(f, v) for values, _, _ in combinations for f, v in zip(FEATURES, values, strict=True)})
    weights, intercept = dict.fromkeys(names, 0.0), 0.0
    total = sum(rows for _, rows, _ in combinations)
    rate = 4.0 / (len(FEATURES) + 1)
    for _ in range(rounds):
        slope, down = dict.fromkeys(names, 0.0), 0.0
        for values, rows, positive in combinations:
            keys = list(zip(FEATURES, values, strict=True))
            z = intercept + sum(weights[k] for k in keys)
            miss = (positive - rows / (1 + math.exp(-max(-30.0, min(30.0, z))))) / total
            down += miss
            for k in keys:
                slope[k] += miss
        intercept += rate * down
        for k in names:
            weights[k] += rate * (slope[k] - ridge * weights[k] / total)
    return SpanModel(intercept, weights)


def fit(candidates: DataFrame, base: str = "__pii_base", wide: str = "__pii_wide") -> SpanModel | None:
    """The span classifier from rows with candidate arrays; None without candidates."""
    one = candidates.select(F.explode(F.concat(base, wide)).alias("s"))
    counted = one.select(*[v.alias(f"v_{k}") for k, v in votes(F.col("s")).items()],
                         *[v.cast("int").alias(f"f_{k}") for k, v in features(F.col("s")).items()])
    counted = counted.groupBy(*counted.columns).count().collect()
    if not counted:
        return None
    patterns: dict[tuple[int, ...], int] = {}
    for r in counted:
        v = tuple(r[f"v_{k}"] for k in LABELERS)
        patterns[v] = patterns.get(v, 0) + r["count"]
    posterior = estimate(patterns).posterior
    sums: dict[tuple[int, ...], list[float]] = {}
    for r in counted:
        both = sums.setdefault(tuple(r[f"f_{k}"] for k in FEATURES), [0.0, 0.0])
        both[0] += r["count"]
        both[1] += r["count"] * posterior[tuple(r[f"v_{k}"] for k in LABELERS)]
    return train_spans([(values, n, p) for values, (n, p) in sorted(sums.items())])


def reported(model: SpanModel | None, base: str = "__pii_base", wide: str = "__pii_wide") -> Column:
    """All spans (start, kind, stop) of a row: base ones and wide ones that the classifier takes."""
    slim = lambda spans: F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"]))
    if model is None:
        return slim(F.col(base))
    return F.array_sort(F.concat(slim(F.col(base)), slim(F.filter(wide, lambda s: model.score(s) >= 0.5))))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256`` and ``spans`` for every document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    rows = saved(with_candidates(slim, "__text").drop("__text"), "pii-candidates")
    model = fit(rows)
    base = F.col("__pii_base")
    return rows.select(
        "doc_id",
        *[_count(base, kind).alias(f"n_{KINDS[kind]}") for kind in range(BASE)],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(reported(model)).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by its kind in brackets; a null text stays null.

    Overlapping spans become one replacement, named after the first.
    """
    rows = with_candidates(docs, text)
    model = fit(saved(rows.select("__pii_base", "__pii_wide").where(
        (F.size("__pii_base") > 0) | (F.size("__pii_wide") > 0)), "pii-candidates"))
    kind = "array<struct<start:long,kind:int,stop:long>>"

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        longer = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["stop"], s["stop"]).alias("stop"))))
        apart = F.concat(acc, F.array(F.struct(
            s["start"].alias("start"), s["kind"].cast("int").alias("kind"), s["stop"].alias("stop"))))
        return F.when(F.size(acc) == 0, apart).when(s["start"] < last["stop"], longer).otherwise(apart)

    rows = rows.withColumn("__pii_spans", F.aggregate(reported(model), F.array().cast(kind), merge))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    spans, body = F.col("__pii_spans"), F.col(text)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["stop"]))
    parts = F.zip_with(spans, F.slice(ends, F.lit(1), F.size(spans)), lambda s, at: F.concat(
        F.substring(body, (at + 1).cast("int"), (s["start"] - at).cast("int")), F.element_at(tags, s["kind"] + 1)))
    tail = F.substring(body, (F.element_at(ends, -1) + 1).cast("int"), F.length(body))
    clean = F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(body)
    return rows.withColumn(text, clean).drop("__pii_base", "__pii_wide", "__pii_spans")
