"""Operators on single texts against plain versions: personal data, secrets, host rules, fingerprints."""

import base64
import json
import time

import pytest
from pyspark.sql import functions as F

import brute
import data
from tidelot.llm import hosts, pii, secrets, simhash

PII_KINDS, SECRET_KINDS = ["email", "ip", "card", "phone"], ["assign", "access", "hex"]


def both(spark):
    frame = data.awkward(spark).unionByName(data.documents(spark).withColumn("doc_id", F.col("doc_id") + 1000), True)
    return frame, {r["doc_id"]: r["text"] or "" for r in frame.collect()}


def test_pii_base_spans_and_added_ones(spark):
    frame, texts = both(spark)
    rows = {r["doc_id"]: r for r in pii.find(frame).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        spans, r = brute.pii_spans(text), rows[i]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[1] == k for s in spans) for k in range(4)], i
        assert r["base_sha256"] == brute.digest(spans, PII_KINDS), i
        assert {f"{PII_KINDS[k]}:{a}:{b}" for a, k, b in spans} <= set(r["spans"].split(",")), i


def test_pii_reports_numbers_in_the_company_of_cues(spark):
    body = "filler words here "
    rows = [(i, f"{body} my account 4556 1234 9876 {1000 + i} today") for i in range(40)]
    rows += [(100 + i, f"{body} a@b{i}.com and 4111 1111 1111 1111 or +1 (212) 555-1{i:03}") for i in range(40)]
    rows += [(200 + i, f"{body} order x{10**21 + i}y") for i in range(40)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum("number" in found[i] for i in range(40) if not brute.pii_spans(rows[i][1])) > 25
    assert not any("number" in found[200 + i] for i in range(40))


def test_redaction_replaces_every_span(spark):
    frame = data.awkward(spark)
    before = {r["doc_id"]: r["text"] for r in frame.collect()}
    after = {r["doc_id"]: r["text"] for r in pii.redact(frame).collect()}
    assert pii.redact(frame).columns == frame.columns
    assert after[0] is None and after[1] == ""
    for i, text in before.items():
        if not brute.pii_spans(text or "") and not any(c.isdigit() for c in text or ""):
            assert after[i] == text
        assert not [s for s in brute.pii_spans(after[i] or "") if s[1] in (0, 2)], i
    assert after[15].startswith("é [CARD] 日本 [EMAIL] \U0001f600 [PHONE] [EMAIL]")


def test_iban_and_luhn(spark):
    row = spark.sql("select 'DE89 3704 0044 0532 0130 00' a, 'DE88370400440532013000' b, '4111111111111111' c").select(
        pii.iban_valid(F.col("a")).alias("a"), pii.iban_valid(F.col("b")).alias("b"), pii.luhn(F.col("c")).alias("c")).first()
    assert (row["a"], row["b"], row["c"]) == (True, False, True)


def test_ibans_before_capitals_are_found(spark):
    codes = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"]
    tails = [" Berlin", " Please", " BIC X", " BIC COBADEFFXXX NOW", ". Then", " A", "", " FR14 2004 1010 0505 0001 3M02 606 Paris",
             " QQ12 ABCD EFGH IJKL DE89 3704 0044 0532 0130 00 OK"]
    rows = [(i, f"pay to {c}{t}") for i, (c, t) in enumerate((c, t) for c in codes for t in tails)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"].split(",") for r in pii.find(frame).collect()}
    masked = {r["doc_id"]: r["text"] for r in pii.redact(frame).collect()}
    for (i, text), code in zip(rows, (c for c in codes for _ in tails), strict=True):
        assert f"iban:7:{7 + len(code)}" in found[i], text
        assert masked[i].startswith("pay to [IBAN]"), masked[i]
        for late in ("FR14 2004 1010 0505 0001 3M02 606", "DE89 3704 0044 0532 0130 00 OK"):
            if late in text:
                at = text.rindex(late)
                assert f"iban:{at}:{at + len(late.removesuffix(' OK'))}" in found[i], text


def test_expectation_maximisation_finds_reliable_labelers():
    # The first two labelers agree, the third votes at random.
    patterns = {(1, 1, v, 0, 0): 100 for v in (-1, 0, 1)} | {(-1, -1, v, 0, 0): 300 for v in (-1, 0, 1)}
    found = pii.estimate(patterns)
    assert abs(found.share - 0.25) < 0.02
    assert all((p > 0.9) == (v[0] == 1) for v, p in found.posterior.items())
    assert found.given[1, 0, 1] > 0.95 and abs(found.given[1, 2, 1] - 1 / 3) < 0.05


def test_secret_base_spans(spark):
    frame, texts = both(spark)
    rows = {r["doc_id"]: r for r in secrets.scan(frame).collect()}
    for i, text in texts.items():
        spans, r = brute.secret_spans(text), rows[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)], i
        assert r["base_sha256"] == brute.digest(spans, SECRET_KINDS), i
        assert {f"{SECRET_KINDS[k]}:{a}:{b}" for a, k, b in spans} <= set(r["spans"].split(",")), i


def der(tag: int, content: bytes) -> bytes:
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + content


RSA = der(0x30, b"".join(der(2, bytes([1] * n)) for n in (1, 129, 3, 128, 64, 64)))
OID = der(6, bytes([42, 134, 72]))
WRAPPED = der(0x30, der(2, b"\0") + der(0x30, OID + der(5, b"")) + der(4, RSA))
BLOB = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-rsa", b"\1\0\1", bytes(range(64))))
SIGNED = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (json.dumps({"alg": "HS256", "typ": "JWT"}).encode(), b'{"sub":1}', b"sig0123456789"))


@pytest.mark.parametrize(("text", "kind"), [
    ("é -----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY----- x", "key"),
    ("x " + base64.b64encode(WRAPPED).decode() + " y", "key"), ("x " + WRAPPED.hex() + " y", "key"),
    ("ssh-rsa " + base64.b64encode(BLOB).decode() + " me", "blob"), ("see " + SIGNED + " now", "signed"),
])
def test_structures_are_confirmed(text, kind):
    assert kind in [k for k, _, _ in secrets.find_secrets(text)[1]]


KEY = base64.b64encode(WRAPPED).decode()
LINES = base64.encodebytes(WRAPPED).decode().strip()


def test_armoured_lines_are_one_key():
    text = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----"
    assert secrets.find_secrets(text)[1] == [("key", 0, len(text))]


@pytest.mark.parametrize(("text", "kind", "secret"), [
    ("PRIVATE_KEY=" + KEY, "key", KEY), ("run --key=" + KEY + " now", "key", KEY),
    ("It was " + SIGNED + ".", "signed", SIGNED), ("It was " + SIGNED + "... Then", "signed", SIGNED),
    ("x " + BLOB.hex() + " y", "blob", BLOB.hex()),
    ("é key:\n" + LINES + "\nend of it", "key", LINES), ("KEY=" + LINES.replace("\n", "\r\n  "), "key", LINES.replace("\n", "\r\n  ")),
    ("-" * 40 + "\n" + LINES.rstrip("=") + "\nend", "key", LINES.rstrip("=")),
    ('"' + LINES.replace("\n", "\\n") + '"', "key", LINES.replace("\n", "\\n")),
    ("ssh-rsa\n" + base64.encodebytes(BLOB).decode() + "me", "blob", base64.encodebytes(BLOB).decode().strip()),
])
def test_neighbours_do_not_hide_structures(text, kind, secret):
    at = text.index(secret)
    assert [x for x in secrets.find_secrets(text)[1] if x[0] == kind] == [(kind, at, at + len(secret))]


@pytest.mark.parametrize("text", [
    "x " + base64.b64encode(RSA[:-1]).decode() + " y", "x " + base64.b64encode(bytes(range(200))).decode(), "A" * 400,
    "eyJhbGciOjF9.eyJ9.abc", "-----BEGIN RSA PRIVATE KEY-----\nQUJD\n-----END RSA PRIVATE KEY-----",
    "x " + base64.b64encode(BLOB + b"\0").decode(),
])
def test_lookalikes_are_not_reported(text):
    assert not [k for k, _, _ in secrets.find_secrets(text)[1] if k in ("key", "blob", "signed")]


def test_host_counts(spark):
    frame, texts = both(spark)
    for r in hosts.judge(frame).collect():
        found = brute.host_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == found, r["doc_id"]
        assert r["base_failed"] == (found[0] < 20 or 100 * found[4] > 30 * found[0])
        assert not (r["base_failed"] and r["kept"])


def test_bad_hosts_take_their_documents_along(spark):
    good = "the quick brown fox jumps over the lazy dog again and again until the very end of the whole long day today"
    rows = [(i, good, "fine") for i in range(50)] + [(100 + i, "short" if i % 10 else good, "bad") for i in range(50)]
    rows += [(200, good, None), (201, "short", "single")]
    kept = {r["doc_id"]: r["kept"] for r in hosts.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(kept[i] for i in range(50)) and not any(kept[100 + i] for i in range(50)) and kept[200] and not kept[201]


def test_fingerprints(spark):
    frame, texts = both(spark)
    for r in simhash.fingerprints(frame, ["doc_id"]).collect():
        assert r["fingerprint"] % 2**64 == brute.fingerprint(texts[r["doc_id"]]), r["doc_id"]


@pytest.mark.parametrize("operator", [pii.find, pii.redact, secrets.scan, hosts.judge, simhash.near_groups])
def test_empty_table(spark, operator):
    assert operator(data.awkward(spark).where("false")).collect() == []


@pytest.mark.parametrize("line", [
    bytes([0x30, 0x83, 0x0F, 0, 0]) + b"A" * 43, (7).to_bytes(4, "big") + b"ssh-rsa" + b"\0" * 37, bytes([0x30, 0x82, 0x2F, 0x00]) + b"\0" * 44])
def test_many_lines_that_begin_like_keys_are_read_once(line):
    """A text of fifty thousand such lines takes time in proportion."""
    text = "\n".join([base64.b64encode(line).decode()] * 50_000)
    start = time.perf_counter()
    assert secrets.find_secrets(text)[0] == []
    assert time.perf_counter() - start < 30


def test_many_matches_in_one_text():
    text = "\n".join(f"password=abcdef{i} AKIA{'A' * 20} {'ab' * 20}" for i in range(20_000))
    start = time.perf_counter()
    assert len(secrets.find_secrets(text)[1]) == 60_000
    assert time.perf_counter() - start < 30
