"""Ranked lexical search, the shingle join and spelling variants against plain versions."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import data
from tidelot.llm import jaccard, lexical, spelling

ITEM = "item_id long, text string, n int, score double, rank string"


def items(spark, extra=()):
    given = spark.read.parquet(str(data.DATA / "benchmark.parquet")).select("item_id", "text").collect()
    rows = [tuple(r) for r in given] + [
        (900, None), (901, ""), (902, "THE the The"), (903, "ab w1x1 w2x2 w3x3"), (903, "often COPIED text"), (904, "Σ İ ſ ﬁ 日本"),
        (None, "text words one two"), (905, "nosuchtermanywhere1"), *extra]
    return spark.createDataFrame([(*r, 1, 0.5, "x") for r in rows], ITEM), rows


def mixed_documents(spark):
    frame = data.awkward(spark, copies=120).unionByName(data.documents(spark).withColumn("doc_id", F.col("doc_id") + 1000), True)
    again = frame.where("doc_id % 7 = 3").unionByName(frame.where("doc_id = 1005").withColumn("doc_id", F.lit(None).cast("long")))
    return frame.unionByName(again)


# --- Ranked lexical search ------------------------------------------------------


@pytest.mark.parametrize(("leaf", "tree", "block_items", "block_terms"), [(48, 16_384, 512, 8192), (2, 40, 3, 30), (1, 7, 1, 1)])
def test_ranks_are_those_of_all_scores(spark, monkeypatch, leaf, tree, block_items, block_terms):
    monkeypatch.setattr(lexical, "LEAF_ROWS", leaf)
    monkeypatch.setattr(lexical, "TREE_ROWS", tree)
    docs = mixed_documents(spark)
    asked, rows = items(spark)
    if block_items == 1:
        rows = [r for r in rows if r[0] in (902, 903, 904, None)]
        asked = asked.where("item_id in (902, 903, 904) or item_id is null")
    got = [tuple(r) for r in lexical.top_documents(docs, asked, 10, block_items=block_items, block_terms=block_terms).collect()]
    expected = brute.best_documents([(r["doc_id"], r["text"]) for r in docs.collect()], rows, 10)
    assert len(got) == len(set(x[:2] for x in got)) and set(got) == expected


def test_bounds_hold_below_every_node():
    dice = np.random.default_rng(1)
    vectors, ids = [], []
    for i in range(300):
        ranks = np.flatnonzero(dice.random(12) < 0.4).astype(">u4")
        if len(ranks):
            vectors.append((ranks.tobytes(), dice.integers(1, 5, len(ranks)).astype(np.int64).tobytes(), int(dice.integers(50, 90))))
            ids.append([(False, i)])
    tree = lexical.Tree(vectors, ids)
    search = lexical.Search(lexical.Weights(np.arange(12), np.arange(12, 0, -1), np.ones((1, 12))), 5)
    stack = [(0, len(tree.norm), 0)]
    while stack:
        low, high, depth = stack.pop()
        bound = search.gains(tree.largest(low, high, 12)[None, :], np.array([tree.norm[low:high].min()])).sum()
        assert (search.gains(tree.counts(low, high, 12), tree.norm[low:high]).sum(axis=1) <= bound).all()
        if high - low > 1:
            parts, deeper = tree.children(low, high, depth)
            assert parts[0][0] == low and parts[-1][1] == high and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
            stack += [(*p, deeper) for p in parts]


def test_lexical_search_of_nothing(spark):
    asked, _ = items(spark)
    docs = data.awkward(spark)
    assert lexical.top_documents(docs.where("false"), asked).count() == 0
    assert lexical.top_documents(docs, asked.where("false")).count() == 0
    assert lexical.top_documents(docs, asked.where("item_id in (900, 901, 905)")).count() == 0


# --- Shingle join ------------------------------------------------------------------


def edited(dice, words, edits):
    words = list(words)
    for _ in range(edits):
        words[dice.randrange(len(words))] = f"e{dice.randrange(10 ** 6)}"
    return " ".join(words)


def crowded(seed=3):
    """Clouds of near copies around one text, a passage of many texts below the border, sizes across bands, short texts."""
    dice = random.Random(seed)
    word = lambda: f"v{dice.randrange(400)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(80)]
    texts = [edited(dice, base, dice.randrange(7)) for _ in range(90)]
    texts += [" ".join(passage + [word() for _ in range(20 + dice.randrange(30))]) for _ in range(70)]
    texts += [" ".join(base[:n]) for n in range(80, 120, 2)]
    texts += [" ".join(word() for _ in range(dice.randrange(1, 6))) for _ in range(40)]
    texts += ["a b c", "A b\tC", "a b c a b c a b c a b c a b c", "x " * 300, "x " * 4, None, "", " ", base and " ".join(base).upper()]
    dice.shuffle(texts)
    return texts


@pytest.mark.parametrize(("tile", "large", "heads", "frequent"), [(1024, 256, 4, 4), (8, 10, 1, 10 ** 9), (3, 4, 1, 2)])
def test_join_is_that_of_all_pairs(spark, monkeypatch, tile, large, heads, frequent):
    monkeypatch.setattr(jaccard, "HEADS", heads)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "NEAREST", 1)
    texts = crowded()
    rules = [(jaccard.Rule(), (85, 100)), (jaccard.Rule(5, Fraction(4, 5)), (4, 5))]
    for rule, (up, down) in rules[: 1 + (tile == 8)]:
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row long, text string").repartition(5)
        got = {r["row"]: (r["n_shingles"], r["root"]) for r in jaccard.near_groups(frame, "row", "text", rule, tile, large).collect()}
        sets = brute.shingle_sets(texts, rule.shingle)
        expected = brute.linked(sets, up, down)
        assert {i: n for i, (n, _) in got.items()} == {i: len(s) for i, s in enumerate(sets)}
        groups = {}
        for i, (_, root) in got.items():
            groups.setdefault(root, set()).add(i)
        wanted = {}
        for i, root in enumerate(expected):
            wanted.setdefault(root, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_join_of_awkward_documents(spark):
    frame = mixed_documents(spark)
    rows = frame.collect()
    got = sorted((tuple(r) for r in jaccard.join_groups(frame).collect()), key=str)
    sets = brute.shingle_sets([r["text"] for r in rows], 4)
    roots, least = brute.linked(sets, 85, 100), {}
    for r, root in zip(rows, roots, strict=True):
        least.setdefault(root, []).append(r["doc_id"])
    named = {root: min((i for i in ids if i is not None), default=None) for root, ids in least.items()}
    assert got == sorted(((r["doc_id"], len(s), named[root]) for r, s, root in zip(rows, sets, roots, strict=True)), key=str)
    assert jaccard.join_groups(frame.where("false")).count() == 0


@pytest.mark.parametrize("members", [150, 300])
def test_a_shared_passage_costs_few_pairs_a_member(spark, monkeypatch, members):
    """Texts that share a passage but are not similar are not compared pair by pair."""
    counted = {}
    keep = jaccard.saved

    def saved(df, name):
        out = keep(df, name)
        counted[name] = max(counted.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "saved", saved)
    dice = random.Random(5)
    passage = [f"p{i}" for i in range(160)]
    texts = [" ".join(passage + [f"w{dice.randrange(10 ** 9)}" for _ in range(38)]) for _ in range(members)]
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(4)
    roots = {r["root"] for r in jaccard.near_groups(frame, "row").collect()}
    assert len(roots) == members
    assert counted["jaccard-first"] <= 8 * members and counted["jaccard-pairs"] <= members and counted["jaccard-grouped"] <= 60 * members


def test_texts_and_signatures_are_written_and_shuffled_once(spark, monkeypatch):
    """Files and signatures are written of classes alone; of texts, those that are in a pair are shuffled, by a filter of bounded size."""
    given, rows = {}, {}
    keep = jaccard.saved

    def saved(df, name):
        given.setdefault(name, df)
        out = keep(df, name)
        rows[name] = max(rows.get(name, 0), out.count() if {"files", "bits", "set"} & set(out.columns) else 0)
        return out

    monkeypatch.setattr(jaccard, "saved", saved)
    dice = random.Random(6)
    texts = [" ".join(f"w{dice.randrange(10 ** 9)}" for _ in range(60)) for _ in range(60)]
    texts += [texts[0], texts[1], texts[2] + " more", texts[3] + " more"]
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    roots = {r["row"]: r["root"] for r in jaccard.near_groups(frame, "row").collect()}
    assert [roots[i] for i in range(60, 64)] == [0, 1, 2, 3] and len(set(roots.values())) == 60
    assert sum(rows[x] for x in rows if "files" in given[x].columns) == 62
    assert rows["jaccard-sets"] == 4
    for name, column in (("jaccard-sets", "text"), ("jaccard-inside", "bits")):
        plan = given[name]._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        leaf = next(i for i, x in enumerate(plan) if "Scan" in x and f"{column}#" in x)
        above, at = [], depth(plan[leaf])
        for x in reversed(plan[:leaf]):
            if depth(x) < at:
                above, at = [*above, x.split("- ")[-1].split()[0]], depth(x)
        assert above.index("BroadcastHashJoin") < above.index("Exchange")


@pytest.mark.parametrize("words", [1 << 18, 4])
def test_filter_of_rows_is_exact(spark, monkeypatch, words):
    monkeypatch.setattr(jaccard, "FILTER_WORDS", words)
    table = spark.range(-500, 500).select((F.col("id") * 8589934597).alias("row"), F.lit("x").alias("content"))
    wanted = table.where("row % 7 = 3").select("row")
    assert sorted(r["row"] for r in jaccard._asked(table, wanted, "row").collect()) == sorted(r["row"] for r in wanted.collect())
    assert jaccard._asked(table, wanted.where("false"), "row").count() == 0


def test_signatures_bound_the_difference():
    dice = np.random.default_rng(2)
    for n, m, both in ((300, 280, 250), (40, 500, 10), (1000, 990, 980), (1, 1, 0)):
        common = dice.integers(0, 2 ** 63, both, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, dice.integers(0, 2 ** 63, k - both, dtype=np.uint64)])) for k in (n, m))
        x, y = jaccard.signature(a), jaccard.signature(b)
        words = min(len(x), len(y))
        apart = int(np.bitwise_count(jaccard.folded(x, words) ^ jaccard.folded(y, words)).sum())
        assert apart <= len(np.setxor1d(a, b))


# --- Spelling variants ---------------------------------------------------------------


def spelled(spark):
    dice = random.Random(4)
    words = ["".join(dice.choice("abcéÿ") for _ in range(dice.randrange(4, 8))) for _ in range(60)]
    rows = [(i, " ".join(dice.choice(words) for _ in range(40)) + " ÀÈÉ ×÷×÷× aaaaaaa AAAAAAA" + ("" if i % 2 else "-Straße"), "x") for i in range(60)]
    rows += [(11, "chains " * 12 + "chainz " * 6 + "chaixz " * 3, "x")]
    rows += [(None, "aaaaab aaaaab aaaaab aaaaa aaaaa aaaaa"), (7, None), (8, ""), (9, "z" * 3000 + " " + "z" * 3001), (9, "z" * 3000 + " " + "z" * 3001),
             (10, "z" * 3000 + " " + "z" * 3001)]
    return spark.createDataFrame([(*r[:2], "y", 5) for r in rows], "doc_id long, text string, word string, n int")


@pytest.mark.parametrize("most", [spelling.FILTER_WORDS, 25])
def test_variants_are_those_of_all_pairs(spark, most):
    frame = spelled(spark)
    got = [tuple(r) for r in spelling.variants(frame, most=most).collect()]
    expected = brute.spelling([(r["doc_id"], r["text"]) for r in frame.collect()])
    assert len(got) == len(expected) and set(got) == expected
    assert any(r[1] != r[2] for r in expected if r[1])


def test_variants_of_documents(spark):
    frame = mixed_documents(spark)
    got = [tuple(r) for r in spelling.variants(frame).collect()]
    expected = brute.spelling([(r["doc_id"], r["text"]) for r in frame.collect()])
    assert len(got) == len(expected) and set(got) == expected
    assert spelling.variants(frame.where("false")).count() == 0
    assert spelling.variants(frame.where("text is null")).count() == 0


def test_filters_hold_every_word_and_little_else(spark):
    words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghi'[i // 1000]}q" for i in range(5000)]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    filters = spelling.build_filters(spark, frame, {5: 5000})
    table = lambda x: np.frombuffer("".join(x).encode("latin-1"), np.uint8).reshape(len(x), -1)
    assert filters.may_hold(5, spelling.word_hashes(table(words))).all()
    others = ["".join(random.Random(i).choice("rstuvé") for _ in range(5)) for i in range(5000)]
    assert filters.may_hold(5, spelling.word_hashes(table(others))).mean() < 0.02
