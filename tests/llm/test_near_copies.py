"""The pipeline's near-copy stage against brute-force Jaccard similarities of five-word shingles."""

import random

import duckdb
import pytest

import corpus_pipeline
from salesmart.llm import near_copies
from tests_support import union

STAGE = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def linked(a, b):
    return len(a & b) * 5 >= len(a | b) * 4


def plain_kept(rows):
    sets = {i: plain_set(t) for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and linked(sets[a], sets[b])]
    return sorted(set(union(sets, pairs).values())), pairs


def test_stage_keeps_what_brute_force_keeps(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{path}' order by doc_id").fetchall()
    want, pairs = plain_kept(rows)
    assert len(pairs) > 90
    assert sorted(r["doc_id"] for r in STAGE(spark, spark.read.parquet(path), "").collect()) == want


@pytest.mark.parametrize("block", [512, 8])
def test_chains_large_groups_and_a_common_line(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    r = random.Random(3)
    new = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    line, base, texts = new(12), new(90), []
    texts += [new(r.randrange(10, 60)) + line for _ in range(80)]
    for _ in range(80):  # near copies of one text, many of which are not near each other
        copy = list(base)
        for _ in range(r.randrange(4)):
            copy[r.randrange(len(copy))] = f"x{r.randrange(10**6)}"
        texts.append(copy)
    chain = new(100)
    for _ in range(15):
        texts.append(chain)
        chain = chain[4:] + new(4)
    texts += [new(3)] * 2 + [[]]
    r.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(len(texts), None)]
    want, _ = plain_kept(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x["doc_id"] for x in STAGE(spark, docs, "").collect()) == want


def test_stage_compares_simhash_classes_first(spark, monkeypatch):
    """Without any band the stage still joins what SimHash classes propose, and only what Jaccard similarity confirms."""
    r = random.Random(5)
    texts = []
    for _ in range(60):  # a word more at the end of a long text: few bits, high similarity
        base = [f"w{r.randrange(10**6)}" for _ in range(400)]
        texts += [base, [*base, f"x{r.randrange(10**6)}"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(len(texts), None), (len(texts) + 1, "")]
    want, _ = plain_kept(rows)
    monkeypatch.setattr(near_copies, "bands", lambda found: [])
    kept = {x["doc_id"] for x in STAGE(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    joined = set(range(len(rows))) - kept
    assert joined <= set(range(len(rows))) - set(want) and len(joined) > 30

    # equal fingerprints are no proof: sets whose similarity is low stay apart
    monkeypatch.setattr(near_copies, "majority", lambda found: 0)
    kept = {x["doc_id"] for x in STAGE(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert kept == set(want)
