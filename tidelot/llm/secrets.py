"""Secret scan with structural confirmation.

Base spans are plain patterns. Further candidates (runs of base64 or hex, signed-token strings, armoured keys) are
reported only when their decoded content has the structure of a secret: DER objects whose nested lengths fill the whole
and hold the integers or octets of a key, length-prefixed key blobs, or a token whose header names an algorithm.

Defined results: a null text counts as empty; an empty text has no spans and the digest of the empty string; places are
code points, ends are exclusive; repeated rows are scanned alike; other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelot.llm.common import ship_package, text_of

#: Kinds in the order of the digest; the first three are the base ones.
KINDS = ["assign", "access", "hex", "key", "blob", "signed"]
ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
ARMOUR = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s\\]+)-----END \1-----")
SIGNED = re.compile(rb"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?!\.*[A-Za-z0-9_-])")
CODED = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_CODED = re.compile(rb"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
# Base64 over several lines; a break may be written as an escape.
BREAK = re.compile(rb"[\x20\t]*(?:\\r\\n|\\n|\r\n?|\n)[\x20\t]*")
WRAPPED = re.compile(
    rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:" + BREAK.pattern + rb"[A-Za-z0-9+/_-]+)+={0,2}")
ASSIGN_HINTS, LEAST_ASSIGNED, LEAST_ACCESS = (b"passw", b"secret", b"token", b"api"), 6, 20
#: Names of length-prefixed key blobs.
BLOB_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-")
OPEN_KEY = b"openssh-key-v1\x00"
#: Deepest nesting of a key, and most objects or strings on one level; a key has far fewer of both.
DEEPEST, MOST_ITEMS = 12, 64


def base_spans(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes."""
    found = []
    low = data.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(data) if len(m.group(1)) >= LEAST_ASSIGNED]
    if b"AKIA" in data:
        found += [("access", *m.span()) for m in ACCESS.finditer(data) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(data)]
    return found


def decoded(chars: bytes) -> bytes | None:
    """Bytes of standard or URL-safe base64, with or without padding; None where it is not base64."""
    plain = re.sub(rb"\\[nr]|\s", b"", chars).translate(bytes.maketrans(b"-_", b"+/")).rstrip(b"=")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + b"=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes | memoryview, depth: int = 0) -> list[tuple[int, memoryview]] | None:
    """(tag, content) of each object in ``data``; None unless definite lengths fill it to the end, nested ones too."""
    data = memoryview(data)
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or depth > DEEPEST or len(items) == MOST_ITEMS:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            size = int.from_bytes(data[at: at + more], "big")
            at += more
        if at + size > len(data):
            return None
        content = data[at: at + size]
        if tag & 0x20 and der_items(content, depth + 1) is None:
            return None
        items.append((tag, content))
        at += size
    return items


def is_der_key(data: bytes | memoryview) -> bool:
    """One sequence that is a key: many integers, or a version or algorithm beside a string of octets or bits."""
    outer = der_items(data) if len(data) >= 24 and data[0] == 0x30 else None
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1]) or []
    tags = [t for t, _ in inner]
    long_integers = sum(t == 2 and len(c) >= 16 for t, c in inner)
    algorithm = any(t == 0x30 and (sub := der_items(c)) and sub[0][0] == 6 for t, c in inner)
    octets = any(t in (3, 4) and len(c) >= 16 for t, c in inner)
    return long_integers >= 2 or octets and (algorithm or tags[:1] == [2])


def is_key_blob(data: bytes | memoryview) -> bool:
    """Length-prefixed strings that fill the whole, the first a key type; or the magic of an armoured key."""
    data = memoryview(data)
    head = bytes(data[: 4 + max(map(len, BLOB_NAMES))])
    if bytes(data[: len(OPEN_KEY)]) == OPEN_KEY:
        return True
    if not head[4:].startswith(BLOB_NAMES):
        return False
    at = parts = 0
    while at + 4 <= len(data) and parts <= MOST_ITEMS:
        at += 4 + int.from_bytes(data[at: at + 4], "big")
        parts += 1
    return at == len(data) and 2 <= parts <= MOST_ITEMS


def is_signed_token(header: bytes, payload: bytes) -> bool:
    """A JSON header that names an algorithm, before a payload that decodes."""
    head, body = decoded(header), decoded(payload)
    if head is None or body is None:
        return False
    try:
        fields = json.loads(head)
    except (ValueError, RecursionError):
        return False
    return isinstance(fields, dict) and isinstance(fields.get("alg"), str)


class Wrapped:
    """Lines of base64 that follow one another, decoded once for each of the four places a key's first letter can have."""

    def __init__(self, data: bytes, match: re.Match) -> None:
        self.lines, start = [], match.start()
        for cut in BREAK.finditer(data, *match.span()):
            self.lines.append((start, cut.start()))
            start = cut.end()
        self.lines.append((start, match.end()))
        parts = [data[a:b].rstrip(b"=") for a, b in self.lines]
        self.sizes = [len(x) for x in parts]
        #: Letters before each line, and before the end.
        self.before = [0, *itertools.accumulate(self.sizes)]
        plain = b"".join(parts).translate(bytes.maketrans(b"-_", b"+/"))
        self.raw = [memoryview(decoded(plain[i: len(plain) - ((len(plain) - i) % 4 == 1)]) or b"") for i in range(4)]
        #: The last line of the run of equally long lines that a line is in.
        self.run_end = list(range(len(parts)))
        for i in range(len(parts) - 2, -1, -1):
            if self.sizes[i + 1] == self.sizes[i]:
                self.run_end[i] = self.run_end[i + 1]

    def content(self, first: int, last: int) -> memoryview | None:
        """What the lines from ``first`` to ``last`` decode to; a view, nothing is copied."""
        low, high = self.before[first], self.before[last + 1]
        if (high - low) % 4 == 1:
            return None
        start = low // 4 * 3
        return self.raw[low % 4][start: start + (high - low) * 3 // 4]

    def last_lines(self, first: int) -> list[int]:
        """Numbers of the last lines that a key may have which begins with line ``first``: DER tells its length, blobs fill lines."""
        head = bytes((self.content(first, first) or self.raw[self.before[first] % 4][self.before[first] // 4 * 3:][: self.sizes[first] // 4 * 3])[:32])
        if len(head) >= 6 and head[0] == 0x30:
            more = head[1] & 0x7F if head[1] & 0x80 else 0
            if more > 4:
                return []
            letters = -(-(2 + more + (int.from_bytes(head[2: 2 + more], "big") if more else head[1])) * 4 // 3)
            last = bisect.bisect_left(self.before, self.before[first] + letters) - 1
            fits = last < len(self.lines) and self.before[last + 1] == self.before[first] + letters
            return [last] if fits and last > first else []
        if head[4:].startswith(BLOB_NAMES) or head.startswith(OPEN_KEY):
            at = self.run_end[first]
            tail = [at + 1] if at + 1 < len(self.lines) and self.sizes[at + 1] < self.sizes[first] else []
            return [i for i in (*tail, at) if i > first]
        return []


def wrapped_spans(data: bytes) -> list[tuple[str, int, int]]:
    """Keys in base64 that is wrapped over lines without armour."""
    found = []
    for m in WRAPPED.finditer(data):
        block, at = Wrapped(data, m), 0
        while at < len(block.lines) - 1:
            after = at + 1
            # First letters of DER, of a length and of the magic.
            for last in block.last_lines(at) if data[block.lines[at][0]] in b"MAb" else ():
                raw = block.content(at, last)
                kind = raw and ("key" if is_der_key(raw) else "blob" if is_key_blob(raw) else None)
                if kind:
                    found.append((kind, block.lines[at][0], block.lines[last][1]))
                    after = last + 1
                    break
            at = after
    return found


def covering(spans: list[tuple[str, int, int]]) -> Callable[[int], bool]:
    """Whether a place lies in one of ``spans``, which come in order and do not overlap."""
    starts, ends = [a for _, a, _ in spans], [b for _, _, b in spans]

    def covers(place: int) -> bool:
        i = bisect.bisect_right(starts, place) - 1
        return i >= 0 and place < ends[i]

    return covers


def confirmed_spans(data: bytes) -> list[tuple[str, int, int]]:
    """Spans whose decoded content has the structure of a secret."""
    found = []
    if b"-----BEGIN " in data:
        for m in ARMOUR.finditer(data):
            raw = decoded(m.group(2))
            if raw and (is_der_key(raw) or is_key_blob(raw)):
                found.append(("key", *m.span()))
    if b"eyJ" in data:
        found += [("signed", *m.span()) for m in SIGNED.finditer(data) if is_signed_token(m.group(1), m.group(2))]
    armoured = covering([x for x in found if x[0] == "key"])
    wrapped = [x for x in wrapped_spans(data) if not armoured(x[1])]
    found += wrapped
    in_wrapped = covering(wrapped)
    for m in CODED.finditer(data):
        if in_wrapped(m.start()):
            continue
        raw = decoded(m.group(0))
        if raw and is_der_key(raw):
            found.append(("key", *m.span()))
        elif raw and is_key_blob(raw):
            found.append(("blob", *m.span()))
    for m in HEX_CODED.finditer(data):
        raw = bytes.fromhex(m.group(0).decode())
        if is_der_key(raw):
            found.append(("key", *m.span()))
        elif is_key_blob(raw):
            found.append(("blob", *m.span()))
    return found


def find_secrets(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and all spans of a text, each by start, then kind, in code points."""
    data = text.encode("utf-8", "surrogatepass")
    base = base_spans(data)
    every = base + confirmed_spans(data)
    if not data.isascii() and every:
        place, at, seen = {}, 0, 0
        for edge in sorted({x for _, a, b in every for x in (a, b)}):
            seen += len(data[at:edge].decode("utf-8", "surrogatepass"))
            place[edge], at = seen, edge
        base = [(k, place[a], place[b]) for k, a, b in base]
        every = [(k, place[a], place[b]) for k, a, b in every]
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted(set(every), key=order)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256`` and ``spans`` for every document."""
    ship_package(docs.sparkSession)
    kind = dict(docs.select(doc_id).dtypes)[doc_id]
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[list, ...] = ([], [], [])
            digests, spans = [], []
            for value in batch.column(1):
                base, every = find_secrets(value.as_py())
                for column, k in zip(counts, KINDS[:3], strict=True):
                    column.append(sum(x[0] == k for x in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string())], names)

    return docs.select(docs[doc_id].alias("doc_id"), text_of(text).alias("__text")).mapInArrow(
        work, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
