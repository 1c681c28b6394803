"""Personal data and secrets against plain patterns over whole texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from salesmart.llm import pii, queries, secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def digits(text):
    return re.sub("[^0-9]", "", text)


def plain_pii(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def plain_secrets(text):
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], secrets.BASE_KINDS.index(s[0])))


def noise(seed, parts, many, longest):
    random.seed(seed)
    return ["".join(random.choice(parts) for _ in range(random.randint(0, longest))) for _ in range(many)]


def test_pii_base_spans_match_plain_patterns(texts):
    parts = ["a", "b.c", "@", "1", "23", ".", "+", " ", "-", "4111111111111111", "(", ")", "255", "é", "@x.y", "192.168.0.1"]
    for text in [t for _, t in texts] + noise(1, parts, 5000, 25):
        assert [s[:3] for s in pii.find_spans(text) if s[4]] == plain_pii(text)


def test_secret_base_spans_match_plain_patterns(texts):
    parts = ["token", "PassWord", "api_key", "APIKEY", "secret", "=", ": ", "'", '"', "AKIA", "ABCDEFGHIJKLMNOP01",
             "abcdef0123456789", "é", "İ", "ſ", "x-y", " ", "deadbeefdeadbeefdeadbeef"]
    words = secrets.automaton()
    for text in [t for _, t in texts] + noise(2, parts, 5000, 15):
        assert [s[:3] for s in secrets.find_spans(text, words) if s[4]] == plain_secrets(text)


@pytest.mark.parametrize("text,kind", [
    ("pay to DE89 3704 0044 0532 0130 00 now", "iban"), ("his ssn is 123-45-6789 ok", "national_id")])
def test_added_personal_kinds(text, kind):
    assert [s[0] for s in pii.find_spans(text) if not s[4]] == [kind]


def test_checksums_reject():
    assert not [s for s in pii.find_spans("pay to DE88 3704 0044 0532 0130 00 now, 123-45-6789") if not s[4]]
    body = "abcdefghijABCDEFGHIJ0123456789"
    good = f"ghp_{body}{secrets.base62_crc(body)}"
    words = secrets.automaton()
    assert [s[0] for s in secrets.find_spans(f"use {good} here", words)] == ["github"]
    assert not secrets.find_spans(f"use {good[:-1]}{'a' if good[-1] != 'a' else 'b'} here", words)
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY-----"
    assert [s[0] for s in secrets.find_spans(key, words)] == ["private_key"]


def test_context_moves_the_score():
    plain, near = pii.find_spans("see 10.0.0.1 there")[0][3], pii.find_spans("the host 10.0.0.1 there")[0][3]
    assert near > plain


@pytest.mark.parametrize("kind,span,doubt", [
    ("ip", "10.0.0.1", "firmware version"), ("card", "4111 1111 1111 1111", "tracking"), ("phone", "+1 555 010 9999", "invoice"),
    ("email", "a@b.co", "sample"), ("iban", "DE89 3704 0044 0532 0130 00", "dummy")])
def test_words_of_doubt_lower_the_score_and_drop_nothing(kind, span, doubt):
    score = lambda text: [s[3] for s in pii.find_spans(text) if s[0] == kind]
    assert score(f"{doubt} {span} here") < score(f"see {span} here") < score(f"{pii.CONTEXT_WORDS[kind][0]} {span} here")
    assert score(f"see {span} here. {'far ' * 20}{doubt}") == score(f"see {span} here")


def test_a_number_of_an_order_is_no_national_id():
    assert [s[0] for s in pii.find_spans("identity 123-45-6789 of the holder")] == ["national_id"]
    assert not pii.find_spans("order id 123-45-6789 of the parts")


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or 10.0.0.1"), (2, None)], "doc_id long, text string")
    assert {r[0]: r[1] for r in pii.redact_pii(docs).collect()} == {1: "mail [email] or [ip]", 2: None}


@pytest.mark.parametrize("name,plain,kinds", [("op3_pii", plain_pii, pii.BASE_KINDS), ("op5_secrets", plain_secrets, secrets.BASE_KINDS)])
def test_registered_queries(spark, sf_dir, texts, name, plain, kinds):
    rows = {r["doc_id"]: r for r in queries.QUERIES[name](spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        want = plain(text)
        assert rows[doc_id]["base_sha256"] == pii.sha256_of(want)
        assert [rows[doc_id][f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in want) for k in kinds]


@pytest.mark.parametrize("find", [pii.find_pii, secrets.find_secrets])
def test_edge_rows(edge_docs, find):
    found = find(edge_docs)
    assert found.count() == edge_docs.count()
    assert found.where(F.size("kinds") > 0).count() == 0
    assert find(edge_docs.limit(0)).count() == 0
