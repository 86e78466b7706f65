"""Operators over whole tables: mixing, search, packing, near copies, chat, the two classifiers, the pipeline."""

import itertools
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import data
from tidelot.llm import chat, components, mixing, packing, quality, queries, search, simhash, toxicity

PATH = queries.tokenizer_path()


# --- Mixing ----------------------------------------------------------------


@pytest.mark.parametrize("bucket_rows", [20_000, 5])
def test_mix_against_plain_sampling(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    frame = data.documents(spark).unionByName(data.awkward(spark).select("doc_id", "text", "source").withColumn(
        "doc_id", F.col("doc_id") + 100_000), True)
    rows = mixing.sized(frame, ["doc_id", "source"]).collect()
    got = {r["doc_id"]: r for r in mixing.mix(mixing.sized(frame, ["doc_id", "source"]), len(rows)).collect()}
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["__mix_key"], r["doc_id"], r["__mix_size"]))
    sizes = {s: sum(x[2] for x in docs) for s, docs in by_source.items()}
    targets = brute.shares(sizes)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for s, docs in by_source.items():
        before, taken, largest = 0, 0, max(x[2] for x in docs)
        epochs = int(targets[s] / sizes[s] + 1e-9) if sizes[s] else 0
        for _, i, n in sorted(docs):
            more = bool(sizes[s]) and 2 * before + n <= 2 * (targets[s] - epochs * sizes[s]) + 1e-6
            assert got[i]["__mix_copies"] == epochs + more, (s, i)
            assert got[i]["__mix_taken"] == (epochs + more) * n <= 3 * n
            assert got[i]["__mix_target"] == pytest.approx(targets[s])
            before, taken = before + n, taken + got[i]["__mix_taken"]
        assert abs(taken - targets[s]) <= largest


def test_mix_deals_whole_rows_once(spark):
    frame = spark.createDataFrame([(1, "a b", "s"), (2, "c", None)], "doc_id long, text string, source string")
    rows = mixing.sized(frame, ["text"])
    plan = mixing.mix(rows, 2)._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    # Below the sums inside a bucket the rows are dealt by it; no exchange parts these sums from the lookup of its state.
    windows = [i for i, line in enumerate(lines) if line.startswith("Window [") and "__mix_bucket" in line]
    assert len(windows) == 1
    above = next(line for line in reversed(lines[:windows[0]]) if not line.startswith(("Project", "Sort ", "Filter")))
    assert "Join" in above


def test_targets_stop_at_three_times_a_source(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 300, None: 5}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(brute.shares(sizes)) and got["a"] == 30


def test_sampling_prefers_heavy_documents(spark):
    ids = spark.range(4000).withColumn("w", F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.2))
    keys = ids.withColumn("key", mixing.sampling_key(F.col("id"), F.col("w"))).orderBy("key").limit(1000)
    assert keys.where("id % 2 = 0").count() > 700


# --- Search ----------------------------------------------------------------


def vectors(spark, n=300, width=8, seed=1, odd=True):
    dice = random.Random(seed)
    rows = [(i, [dice.gauss(0, 0.2) for _ in range(width)], 0) for i in range(n)]
    if odd:
        same = [0.5] * width
        rows += [(1000 + i, same, 0) for i in range(60)]
        rows += [(2000, None, 0), (2050, [None] * width, 0), (2100, [float("nan")] * width, 0), (2150, [float("inf")] + [0.0] * (width - 1), 0), (2200, [0.1], 0), (None, same, 0)]
        rows += [rows[3], rows[50]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 16)])
def test_top_k_is_exact(spark, monkeypatch, blocks):
    monkeypatch.setattr(search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(search, "CANDIDATE_BLOCK", blocks[1])
    frame = vectors(spark)
    usable = {r["vec_id"]: r["embedding"] for r in frame.collect() if r["vec_id"] is not None and r["vec_id"] < 2000}
    asked = [i for i in usable if i % 50 == 0]
    got = {tuple(r) for r in search.top_k(frame, frame.where("vec_id % 50 = 0"), 5).collect()}
    assert got == brute.top_k(usable, asked, 5)


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 16)])
def test_top_k_of_an_id_with_several_vectors(spark, monkeypatch, blocks):
    monkeypatch.setattr(search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(search, "CANDIDATE_BLOCK", blocks[1])
    frame = vectors(spark, 120, odd=False)
    rows = [(50, [3.0 + i / 8] * 8, 0) for i in range(7)] + [(51, [2.0] * 8, 0), (51, [1.0] * 8, 0), (50, [2.0] * 8, 0)]
    frame = frame.where("vec_id != 50").union(spark.createDataFrame(rows, frame.schema))
    whole = [(r["vec_id"], np.floor(256 * np.array(r["embedding"])).astype(int).tolist()) for r in frame.collect()]
    got = {tuple(r) for r in search.top_k(frame, frame.where("vec_id % 50 = 0"), 5).collect()}
    expected = set()
    for q in (0, 50, 100):
        ask = min(x for i, x in whole if i == q)
        best = sorted((-int(np.dot(ask, x)), i) for i, x in whole if i != q)[:5]
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert got == expected


@pytest.mark.parametrize("common", [3, 40])
def test_top_k_within_each_length(spark, common):
    """Queries of the rarer and of the more common length alike meet their own length."""
    dice = random.Random(2)
    rows = [(50 * i if i < 4 else 1000 + i, [dice.gauss(0, 1) for _ in range(4)], 0) for i in range(common)]
    rows += [(25 + 50 * i if i else 100_000, [dice.gauss(0, 1) for _ in range(7)], 0) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {tuple(r) for r in search.top_k(frame, frame.where("vec_id % 50 = 0"), 5).collect()}
    expected = set()
    for width in (4, 7):
        part = {i: v for i, v, _ in rows if len(v) == width}
        expected |= brute.top_k(part, [i for i in part if i % 50 == 0], 5)
    assert got == expected and any(q == 100_000 for q, *_ in got)


@pytest.mark.parametrize("large", [1e17, 1e300, 2.0 ** 45])
def test_top_k_of_far_components(spark, monkeypatch, large):
    """Components beyond 64 bits, a far one among small ones; ranks are those of the exact integers."""
    monkeypatch.setattr(search, "SLICE", 2)
    dice = random.Random(8)
    rows = [(i, [dice.gauss(0, 1) for _ in range(3)], 0) for i in range(60)]
    rows += [(100, [large, -large, large], 0), (101, [-large, large, 1.0], 0), (150, [large, 0.0, 0.5], 0), (200, [0.0, 0.0, 0.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {tuple(r) for r in search.top_k(frame, frame.where("vec_id % 50 = 0"), 5).collect()}
    whole = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v, _ in rows}
    expected = set()
    for q in (0, 50, 100, 150, 200):
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], x)), i) for i, x in whole.items() if i != q)[:5]
        expected |= {(q, r + 1, i, min(max(-s, -2 ** 63), 2 ** 63 - 1)) for r, (s, i) in enumerate(ranked)}
    assert got == expected


def test_one_far_component_costs_one_cell(spark):
    frame = vectors(spark, 400, odd=False).unionByName(spark.createDataFrame(
        [(9999, [1e9] + [0.0] * 7, 0)], "vec_id long, embedding array<double>, rank int"))
    exact = search.classes(search.usable(frame), 6).withColumn("class", F.monotonically_increasing_id())
    edges = np.array(search.grids(exact).first()["borders"]).reshape(8, 257)
    assert edges[0, -1] == 1e9 and (np.diff(edges, axis=1) >= 0).all() and edges[0, -3] < 10


def test_order_keys_sort_as_integers():
    numbers = [0, 1, -1, 255, 256, -255, -256, -257, 2 ** 63, -2 ** 63, 10 ** 40, -10 ** 40, 10 ** 40 + 1]
    assert sorted(numbers) == sorted(numbers, key=search.order_key)


def test_top_k_with_few_candidates_and_none(spark):
    frame = vectors(spark, 3, odd=False)
    assert search.top_k(frame, frame.where("vec_id = 0"), 5).count() == 2
    assert search.top_k(frame.where("false"), frame, 5).count() == 0
    assert search.top_k(frame, frame.where("false"), 5).count() == 0


# --- Packing ---------------------------------------------------------------


def check_packing(rows, capacity=4096, documents=4096, attention=4096 ** 2):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and len(parts) <= documents and sum(n * n for _, n in parts) <= attention
    return len(bins)


def test_packing_round_trip(spark):
    frame = data.awkward(spark, copies=30).unionByName(data.documents(spark).withColumn("doc_id", F.col("doc_id") + 1000), True)
    rows = packing.pack(frame, PATH).collect()
    coder = packing.tokenizer(PATH)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    texts = {r["doc_id"]: r["text"] or "" for r in frame.collect()}
    assert pieces.keys() == texts.keys()
    for i, text in texts.items():
        ids = [*coder.encode(text, add_special_tokens=False).ids, 1]
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            part = ids[n * 4096: (n + 1) * 4096]
            assert (r["piece"], r["start"], r["length"]) == (n, n * 4096, len(part)), i
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()), i
        assert (len(pieces[i]) - 1) * 4096 < len(ids) <= len(pieces[i]) * 4096
    total = sum(r["length"] for r in rows)
    assert check_packing(rows) <= -(-total // 4096) + 1


def test_words_are_coded_apart_and_the_memory_may_be_small():
    text = "İstanbul ΣΑΣ <|endoftext|>x don't é  a b 12a ​z " * 3
    for known in (150_000, 4):
        got = packing.WordIds(PATH, known).encode(text).tolist()
        assert got == packing.tokenizer(PATH).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(4096, 4096, 4096 ** 2), (100, 5, 4000), (100, 100, 3000)])
def test_plan_keeps_every_constraint(rule, limits):
    dice = random.Random(5)
    counts = {n: dice.randint(1, 40) for n in range(1, 55)}
    rows, left = [], dict(counts)
    for run in packing.plan(counts, *limits, rule=rule):
        assert run.first == counts[run.length] - left[run.length]
        left[run.length] -= run.count
        rows += [{"sequence_id": run.bin + i, "offset": run.offset, "length": run.length} for i in range(run.count)]
    assert not any(left.values())
    tokens, attention = sum(n * c for n, c in counts.items()), sum(n * n * c for n, c in counts.items())
    least = max(-(-tokens // limits[0]), -(-sum(counts.values()) // limits[1]), -(-attention // limits[2]))
    assert least <= check_packing(rows, *limits) <= 1.3 * least + 1


def test_packing_nothing(spark):
    assert packing.pack(data.awkward(spark).where("false"), PATH).collect() == []


# --- Near copies -----------------------------------------------------------


def test_groups_of_near_copies(spark):
    frame = data.awkward(spark, copies=40).unionByName(data.documents(spark).withColumn("doc_id", F.col("doc_id") + 1000), True)
    rows = sorted(frame.collect(), key=lambda r: r["doc_id"])
    fps = [brute.fingerprint(r["text"] or "") for r in rows]
    expected = brute.components(fps, [r["doc_id"] for r in rows])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_groups(frame).collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(rows, fps, expected, strict=True)}


@pytest.mark.parametrize("file_rows", [2, 32])
def test_links_reach_all_close_fingerprints(spark, file_rows):
    dice = random.Random(3)
    heads = [dice.getrandbits(64) for _ in range(6)] + [0, 2 ** 64 - 1]
    fps = set(heads)
    for h in heads:
        for _ in range(60):
            x = h
            for b in dice.sample(range(64), dice.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    frame = spark.createDataFrame([(x - 2 ** 64 if x >= 2 ** 63 else x,) for x in fps], "f long")
    found = simhash.links(frame, file_rows=file_rows)
    assert all(bin((r["a"] ^ r["b"]) % 2 ** 64).count("1") <= 2 for r in found.collect())
    roots = {r["node"] % 2 ** 64: r["root"] % 2 ** 64 for r in components.components(found).collect()}
    expected = brute.components(fps, list(range(len(fps))))
    groups, wanted = defaultdict(set), defaultdict(set)
    for x, e in zip(fps, expected, strict=True):
        groups[roots.get(x, x)].add(x)
        wanted[e].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in components.components(chain).collect()} == {0}


def edited(dice, words, n):
    words = list(words)
    for at in dice.sample(range(len(words)), n):
        words[at] = f"new{dice.randint(0, 10 ** 6)}"
    return " ".join(words)


def similar_texts():
    """Families of texts with a few edited words, on both sides of the border, and one large family."""
    dice, texts = random.Random(6), []
    for size in (60, 204, 204, 504):
        words = [f"w{dice.randint(0, 5000)}" for _ in range(size)]
        texts += [" ".join(words)] + [edited(dice, words, n) for n in (0, 1, 1, 2, 3, 4, 5, 6, 9, 12)]
    hot = [f"h{dice.randint(0, 5000)}" for _ in range(120)]
    return texts + [edited(dice, hot, dice.choice([1, 1, 2, 4])) for _ in range(120)] + [*data.TEXTS[:8], "Two  WORDS", None]


def test_similar_texts_against_all_pairs(spark):
    import corpus_pipeline as pipeline

    texts = similar_texts()
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(r["doc_id"] for r in pipeline.STAGES[1][1](spark, frame.repartition(5), "").collect())
    assert got == sorted(min(g) for g in brute.similar_groups(texts))


# --- Chat ------------------------------------------------------------------


def least_cost(roles):
    """All ways, by exhaustive search."""
    best = {"start": 0.0}
    for role in roles:
        new = {}
        for state, cost in best.items():
            for target in ("system", "user", "assistant"):
                legal = {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
                relabel = 0.0 if role == target else chat.RELABEL
                ways = [c for ok, c in (((state, target) in legal, relabel), (state == target, relabel + chat.MERGE)) if ok]
                ways += [relabel + chat.INSERT for mid in ("user", "assistant") if (state, mid) in legal and (mid, target) in legal]
                for c in ways:
                    new[target] = min(new.get(target, 1e9), cost + c)
        best = new
    return min(c + {"assistant": 0, "user": chat.INSERT}.get(s, 2 * chat.INSERT) for s, c in best.items())


def legal(roles):
    roles = roles[1:] if roles[:1] == ["system"] else roles
    return roles and len(roles) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(roles))


@pytest.mark.parametrize("parts", [1, 7])
def test_repair_is_least_and_legal(spark, parts):
    dice = random.Random(4)
    rows, chats = [], {}
    for conv, n in enumerate([1, 1, 1, 2, 3, 400, *[dice.randint(1, 8) for _ in range(60)]]):
        roles = [dice.choice(["system", "user", "assistant", "User ", "tool", None]) for _ in range(n)]
        chats[conv] = roles
        rows += [(conv, t, r, f"t{t}" if t else None, t, 0.5) for t, r in enumerate(roles)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part long, cost double")
    got = defaultdict(list)
    for r in chat.repair(frame.repartition(5), parts=parts).collect():
        got[r["conv_id"]].append(r)
    assert got.keys() == chats.keys()
    for conv, roles in chats.items():
        out = sorted(got[conv], key=lambda r: r["place"])
        assert [r["place"] for r in out] == list(range(len(out)))
        assert legal([r["role"] for r in out if r["action"] != "merge"])
        assert [r["turn"] for r in out if r["turn"] is not None] == list(range(len(roles)))
        clean = [(r or "").strip().lower() or None for r in roles]
        cost = sum(
            (chat.INSERT if r["action"] == "insert" else 0) + (chat.MERGE if r["action"] == "merge" else 0)
            + (chat.RELABEL if r["turn"] is not None and r["role"] != clean[r["turn"]] else 0) for r in out)
        assert {r["cost"] for r in out} == {cost}
        assert cost == least_cost(clean), roles
        text = "".join(r["fragment"] for r in out)
        assert text.count("<|end|>") == sum(r["action"] != "merge" for r in out) and text.endswith("<|end|>\n")


def test_repair_of_odd_tables(spark):
    frame = spark.createDataFrame([(None, None, None, None)] * 3 + [(1, 5, "user", "a"), (1, 5, "user", "a"), (1, None, "assistant", "b")],
                                  "conv_id long, turn long, role string, text string")
    got = chat.repair(frame).collect()
    assert sum(r["conv_id"] is None for r in got) >= 3
    assert [r["action"] for r in sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["place"])] == ["keep", "merge", "keep"]
    assert chat.repair(frame.where("false")).collect() == []


# --- Classifiers -----------------------------------------------------------


def held_out(rows, labels, name):
    pairs = [(r["predicted"], r["score"], labels[r["doc_id"]][name]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(0 <= s <= 1 and p == int(s >= 0.3) for p, s, _ in pairs)
    return sum(p == y for p, _, y in pairs) / len(pairs), pairs


@pytest.mark.parametrize(("query", "label", "least", "sf"), [
    ("op1_quality", "quality", 0.95, "0.01"), ("op6_toxicity", "toxic", 0.95, "0.1")])
def test_held_out_accuracy(spark, query, label, least, sf):
    sf = f"/root/testdata/sf{sf}"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES[query](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    accuracy, pairs = held_out(rows, labels, label)
    assert accuracy >= least
    ranked = [(s1 > s0) + 0.5 * (s1 == s0) for (_, s1, y1), (_, s0, y0) in itertools.product(pairs, pairs) if y1 > y0]
    assert sum(ranked) / len(ranked) > 0.9


@pytest.mark.parametrize("labels", [[], [(4, 1, 1)], [(i, i % 2, i % 2) for i in range(24)] + [(None, 1, 1), (3, None, None)]])
def test_classifiers_take_awkward_rows(spark, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = data.awkward(spark)
    model = quality.train(frame, known)
    scored = quality.score(frame, model)
    assert set(scored.columns) == {*frame.columns, "__quality_score"}
    assert all(0 <= r["__quality_score"] <= 1 for r in scored.collect())
    rows = toxicity.detect(frame, known).collect()
    assert len(rows) == len(data.TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.detect(frame.where("false"), known).collect() == []


def test_rules_match_the_trees_they_come_from(spark):
    rule = quality.Rule((("symbols", False, 0.5), ("words", True, 10.0)))
    frame = spark.createDataFrame([(0.4, 5.0), (0.6, 5.0), (0.6, 11.0)], "symbols double, words double")
    got = [r[0] for r in frame.select(rule.column({c: F.col(c) for c in frame.columns})).collect()]
    assert got == [False, True, False]


def test_maximal_segments_against_exhaustive_search():
    def recursive(scores, at=0):
        best, span = 0.0, None
        for a in range(len(scores)):
            total = 0.0
            for b in range(a, len(scores)):
                total += scores[b]
                if total > best + 1e-12:
                    best, span = total, (a, b)
        if span is None:
            return []
        a, b = span
        return recursive(scores[:a], at) + [(at + a, at + b, best)] + recursive(scores[b + 1:], at + b + 1)

    dice = random.Random(9)
    for _ in range(300):
        scores = [dice.uniform(0.5, 3) if dice.random() < 0.4 else -0.7 for _ in range(dice.randint(0, 30))]
        got = toxicity.maximal_segments([(i, s) for i, s in enumerate(scores) if s > 0], -0.7)
        want = recursive(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_maximal_segments_of_many_hits_are_found_in_one_pass():
    hits = [(3 * i, 1.0 + 1e-6 * (i % 7)) for i in range(200_000)]
    assert sum(s for *_, s in toxicity.maximal_segments(hits, -1.0)) > 0


def test_toxic_passages_are_placed(spark):
    rows = [(i, f"word{'abcdefghij'[i % 10]} calm text here and more zonk blarg zonk tail", 1) for i in range(30)]
    rows += [(100 + i, f"word{'abcdefghij'[i % 10]} calm text here and more tail again", 0) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts = {i: t for i, t, _ in rows}
    for r in toxicity.detect(frame.drop("toxic"), frame.select("doc_id", "toxic")).collect():
        assert (r["score"] >= 0.5) == (r["key"] < 100)
        if r["key"] < 100:
            assert [texts[r["key"]][s["start"]: s["stop"]] for s in r["segments"]] == ["zonk blarg zonk"]


# --- Pipeline --------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    sf = str(data.DATA)
    docs = data.documents(spark)
    kept = pipeline.keep_quality(spark, docs, sf)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    good = [i for i, y in labels.items() if y == 1]
    assert kept.columns == docs.columns and sum(i in ids for i in good) >= 0.97 * len(good)

    first = pipeline.drop_near_copies(spark, docs.union(docs), sf)
    rows = docs.collect()
    groups = brute.components([brute.fingerprint(r["text"] or "") for r in rows], [r["doc_id"] for r in rows])
    assert sorted(r["doc_id"] for r in first.collect()) == sorted(set(groups))

    assert pipeline.mask_personal_data(spark, docs, sf).where("n_chars != length(text)").count() == 0
    mixed = pipeline.mix_sources(spark, docs, sf)
    assert mixed.columns == docs.columns and max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
    packed = pipeline.run(spark, sf).collect()
    assert check_packing(packed) <= -(-sum(r["length"] for r in packed) // 4096) + 1


@pytest.mark.parametrize("stage", ["drop_near_copies", "drop_similar"])
def test_near_copies_are_dropped_by_row_not_by_id(spark, stage):
    import corpus_pipeline as pipeline

    texts = [" ".join(f"{name}{i}" for i in range(40)) for name in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (None, None), (7, texts[2]), (7, texts[3]), (7, texts[0]), (3, texts[2]),
            (None, texts[4]), (None, texts[4]), (9, texts[5]), (9, texts[5])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in getattr(pipeline, stage)(spark, frame.repartition(4), "").collect()]
    assert sorted(got, key=str) == sorted(
        [(7, texts[0]), (None, texts[1]), (None, None), (3, texts[2]), (7, texts[3]), (None, texts[4]), (9, texts[5])], key=str)


@pytest.mark.parametrize("stage", range(4))
def test_stages_take_awkward_and_empty_tables(spark, stage):
    import corpus_pipeline as pipeline

    frame = data.awkward(spark, copies=3)
    run = pipeline.STAGES[stage][1]
    for docs in (frame, frame.where("false")):
        out = run(spark, docs, str(data.DATA))
        assert out.columns == docs.columns
        out.collect()
