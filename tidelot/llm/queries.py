"""Registered queries of the training-data operators and their DuckDB SQL where there is one."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelot.llm import (
    chat, hosts, jaccard, lexical, mixing, packing, pii, quality, search, secrets, simhash, spelling, toxicity,
)
from tidelot.llm.common import fold, saved

LEAST_SCORE = 0.3
#: A tokenizer file that every machine can open in place of the installed one.
TOKENIZER_VARIABLE = "TIDELOT_TOKENIZER"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return os.environ.get(TOKENIZER_VARIABLE) or public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learned where crc32(id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), allowed=fold("key", 5) != 0)
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("__quality_score").alias("score"),
                         (F.col("__quality_score") >= LEAST_SCORE).cast("int").alias("predicted"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, repaired and rendered."""
    return chat.repair(table(spark, sf_dir, "conversations"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    docs = table(spark, sf_dir, "documents")
    rows = saved(mixing.sized(docs, ["doc_id"]), "mix-sizes")
    mixed = mixing.mix(rows, rows.count())
    return mixed.select("doc_id", F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"),
                        F.round("__mix_target", 6).alias("target"), F.col("__mix_taken").alias("taken"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned where crc32(id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.detect(docs, table(spark, sf_dir, "labels"), allowed=fold("key", 4) != 2)
    passages = F.array_join(F.transform("segments", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return found.select(F.col("key").alias("doc_id"), (fold("key", 4) == 2).alias("held_out"), "score",
                        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"), passages.alias("passages"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for every document and the verdict of its host."""
    return hosts.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("host_rate", 6).alias("host_rate"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return lexical.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of four-word shingles are similar to 85 in 100."""
    return jaccard.join_groups(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its variants' form and root."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_pii, op3_chat, op4_mix, op5_secrets, op6_toxicity, op7_top_k, op8_pack, op9_hosts, op10_simhash,
    op11_lexical, op12_jaccard, op13_spelling)}

WORD_LIST = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, len({WORD_LIST}) AS size,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight FROM s),
-- The level at which all caps and shares together are the total: between two caps it is linear, so the right one fits its own gap.
c AS (SELECT a.source, (any_value(t.total) - coalesce(sum(3.0 * b.source_size) FILTER (b.source_size / b.weight < a.source_size / a.weight), 0))
   / sum(b.weight) FILTER (b.source_size / b.weight >= a.source_size / a.weight) AS level,
  any_value(3.0 * a.source_size / a.weight) AS rate
 FROM w a, w b, (SELECT sum(source_size) AS total FROM s) t GROUP BY a.source),
l AS (SELECT min_by(level, rate) AS level FROM c WHERE level <= rate * (1 + 1e-12)),
t AS (SELECT source, source_size, least(3.0 * source_size, level * weight) AS target FROM w, l),
k AS (SELECT d.*, t.source_size, t.target,
  -ln((CAST(concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 1, 12)) AS BIGINT) + 0.5) / 281474976710656.0)
   / ((size + 1) / CAST(size + 1 + symbols AS DOUBLE)) AS key,
  CASE WHEN t.source_size > 0 THEN CAST(floor(target / t.source_size) AS BIGINT) ELSE 0 END AS epochs
 FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target, CAST(size * (epochs
 + CASE WHEN source_size > 0 AND 2 * start + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM p
"""

SEARCH_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

HOSTS_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORD_LIST} AS w FROM documents),
lines AS (SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
windows AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) z WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, 8)) AS j) o GROUP BY doc_id),
m AS (SELECT d.doc_id, source, len(w) AS n_words, len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
  coalesce(r.n, 0) AS n_repeat_words FROM d JOIN lines USING (doc_id) LEFT JOIN repeated r ON r.doc_id = d.doc_id),
b AS (SELECT *, n_words < {hosts.LEAST_WORDS} OR 100 * n_repeat_words > {hosts.MOST_REPEATED} * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 100 * n_symbols > {hosts.MOST_SYMBOLS} * n_words OR 100 * n_dup_lines > {hosts.MOST_DUP_LINES} * n_lines AS failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS k FROM f GROUP BY source),
o AS (SELECT sum(k) / CAST(sum(n) AS DOUBLE) AS mean, count(*) / CAST(sum(n) AS DOUBLE) AS noise FROM h),
v AS (SELECT any_value(mean) AS mean, sum(n * pow(k / CAST(n AS DOUBLE) - mean, 2)) / sum(n) - any_value(mean * (1 - mean) * noise) AS spread FROM h, o),
s AS (SELECT mean, CASE WHEN spread <= 0 THEN {hosts.MOST_STRENGTH} ELSE greatest({hosts.LEAST_STRENGTH},
  least({hosts.MOST_STRENGTH}, mean * (1 - mean) / spread - 1)) END AS strength FROM v),
r AS (SELECT source, (k + mean * strength) / (n + strength) AS rate FROM h, s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
 CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
 NOT failed AND rate <= {hosts.MOST_FAILING} AS kept, round(rate, 6) AS host_rate
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LEXICAL_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
  regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")},
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
o AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
c AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(t) AS term FROM d) x WHERE term IN (SELECT term FROM q) GROUP BY k, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
 FROM (SELECT term, count(*) AS df FROM c GROUP BY term) f, o),
m AS (SELECT k, doc_id, 100 - 50 + (50 * CAST(len(t) AS BIGINT) * n_docs) // n_terms AS m FROM d, o WHERE len(t) > 0),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
 FROM q JOIN c USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY item_id, k, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= {lexical.TOP}
"""

JACCARD_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(list_slice(w, i, i + 3), ' ') FOR i IN range(1, len(w) - 2)] END) AS g FROM d),
e AS MATERIALIZED (SELECT doc_id, unnest(g) AS x FROM s),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
shared AS (SELECT a.doc_id AS p, b.doc_id AS q, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT p, q FROM shared JOIN n a ON a.doc_id = p JOIN n b ON b.doc_id = q WHERE 100 * k >= 85 * (a.n + b.n - k)),
reach(p, q) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.p, link.q FROM reach JOIN link ON link.p = reach.q)
SELECT n.doc_id, any_value(n.n) AS n_shingles, min(q) AS component_id FROM n JOIN reach ON reach.p = n.doc_id GROUP BY n.doc_id
"""


def _crc_table() -> str:
    """The 256 remainders of the reflected CRC-32 polynomial, by its rule."""
    out = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(str(x))
    return "[" + ", ".join(out) + "]"


# A digest is computed once for each document and word; its bytes come from their hexadecimal form.
SPELLING_SQL = rf"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
u AS (SELECT doc_id, run, count(*) AS n, hex(encode(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run))) AS h FROM r GROUP BY doc_id, run),
t AS MATERIALIZED (SELECT {_crc_table()} AS t),
c AS (SELECT doc_id, run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  [CAST(concat('0x', substr(h, 2 * i - 1, 2)) AS BIGINT) FOR i IN range(1, len(h) // 2 + 1)]),
  lambda a, b: xor(a >> 8, t.t[(xor(a, b) & 255) + 1]))) AS crc FROM u, t),
x AS (SELECT CASE WHEN crc % 97 = 0 THEN concat(substr(run, 1, CAST(crc % length(run) AS INT)), substr(run, CAST(crc % length(run) AS INT) + 2))
  ELSE run END AS word, n FROM c),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM x WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
cut AS (SELECT DISTINCT word, n, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest FROM p),
gap AS (SELECT word, n, i, concat(substr(word, 1, i - 1), ' ', substr(word, i + 1)) AS rest FROM p),
near AS (SELECT a.word, b.word AS other, b.n FROM gap a JOIN gap b ON a.rest = b.rest AND a.word <> b.word
 UNION ALL SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = cut.rest
 UNION ALL SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = cut.rest),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
first AS (SELECT near.word, min(other) AS form FROM near JOIN best ON near.word = best.word AND near.n = best.top GROUP BY near.word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * v.n THEN form END AS form,
  CASE WHEN top >= 2 * v.n THEN top END AS form_n FROM v LEFT JOIN best USING (word) LEFT JOIN first USING (word)),
walk(word, place, further) AS (SELECT word, word, form FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.further)
SELECT f.word, f.form, walk.place AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM f JOIN walk ON walk.word = f.word AND walk.further IS NULL
"""

ORACLES: dict[str, str] = {
    "op4_mix": MIX_SQL, "op7_top_k": SEARCH_SQL, "op9_hosts": HOSTS_SQL, "op11_lexical": LEXICAL_SQL, "op12_jaccard": JACCARD_SQL,
    "op13_spelling": SPELLING_SQL,
}
