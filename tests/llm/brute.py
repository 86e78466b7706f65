"""Plain single-machine versions of the training-data queries, written from their contracts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_spans(text: str) -> list[tuple[int, int, int]]:
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m)) <= 19 and luhn(digits(m)):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    for k, p, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), k, m.end()) for m in re.finditer(p, text) if m.end() - m.start() >= least]
    return sorted(found)


def digest(spans, kinds) -> str:
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def shares(sizes: dict, weights=(5, 2, 1), most=3.0) -> dict:
    """Targets by sharing again and again what is above a cap."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap = {s: most * sizes[s] for s in names}
    target, open_, rest = {}, set(names), float(sum(sizes.values()))
    while open_:
        each = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if each * weight[s] > cap[s] + 1e-9}
        if not over:
            return target | {s: each * weight[s] for s in open_}
        target |= {s: cap[s] for s in over}
        rest -= sum(cap[s] for s in over)
        open_ -= over
    return target


def repeat_words(words: list[str]) -> int:
    windows: dict = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i: i + 8]), []).append(i)
    return len({i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)})


def host_counts(text: str) -> tuple[int, int, int, int, int]:
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            repeat_words(words))


def fingerprint(text: str) -> int:
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: list[int], ids: list[int], distance: int = 2) -> list[int]:
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least: dict = {}
    for i in range(len(fps)):
        least[find(i)] = min(least.get(find(i), math.inf), ids[i])
    return [least[find(i)] for i in range(len(fps))]


def similar_groups(texts: list) -> list[set[int]]:
    """Connected components of Jaccard 0.8 on five-word shingles, by all pairs."""
    sets = []
    for t in texts:
        words = (t or "").encode().lower().split()
        sets.append({b" ".join(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    groups: list[set[int]] = []
    for i, s in enumerate(sets):
        near = [g for g in groups if any(s == sets[j] or 5 * len(s & sets[j]) >= 4 * len(s | sets[j]) for j in g)]
        groups = [g for g in groups if g not in near] + [{i}.union(*near)]
    return groups


def top_k(vectors: dict[int, list[float]], queries: list[int], k: int) -> set[tuple[int, int, int, int]]:
    whole = {i: np.floor(256 * np.array(v, float)).astype(np.int64) for i, v in vectors.items()}
    out = set()
    for q in queries:
        ranked = sorted((-int(whole[q] @ x), i) for i, x in whole.items() if i != q)[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)}
    return out


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def best_documents(docs: list[tuple], items: list[tuple], k: int) -> set[tuple]:
    """Every document scored for every item: ``(item_id, rank, doc_id, score)``; terms of one item id are taken together."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    texts = [(i, Counter(term.findall(lower(t)))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(term.findall(lower(t)))
    out = set()
    for item, terms in asked.items():
        scored = []
        for doc, counts in texts:
            m = 50 + (50 * sum(counts.values()) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * counts[t]) // (1000 * counts[t] + 20 * m))
                        for t in terms if t in counts)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scored)[:k]):
            out.add((item, rank + 1, None if null else doc, -score))
    return out


def shingle_sets(texts: list, words: int) -> list[set]:
    out = []
    for t in texts:
        w = WORDS.findall(lower(t))
        out.append({tuple(w[i: i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    return out


def linked(sets: list[set], up: int, down: int) -> list[int]:
    """Component of each set, by all pairs; equal sets are linked unless they are empty."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and down * len(a & sets[j]) >= up * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def spelling(docs: list[tuple]) -> set[tuple]:
    """Near words by all pairs: ``(word, form, root, n, n_near, form_n)``."""
    counts: Counter = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    by_length: dict = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    form, n_near = {}, {}
    for w, n in words.items():
        others = [v for d in (-1, 0, 1) for v in by_length.get(len(w) + d, ()) if v != w and near(w, v)]
        n_near[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, n_near[w], words.get(form.get(w))) for w, n in words.items()}
