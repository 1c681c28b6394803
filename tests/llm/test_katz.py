"""Katz scores against dictionaries of counts."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from salesmart.llm import katz, queries


def plain(texts):
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens]
    train = [t for (_, t), h in zip(tokens, held, strict=True) if not h]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([b" start", *t], t))
    n, v = sum(one.values()), len(one)
    first, second = (katz.good_turing([Counter(c.values())[r] for r in range(1, 7)]) for c in (one, two))
    given = lambda r, d: r * d[r - 1] if r <= 5 else r - katz.LARGE_GIVES
    unknown = 1 - sum(given(r, first) for r in one.values()) / n if n else 1.0
    alone = lambda w: given(one[w], first) / n if w in one else unknown
    after = defaultdict(dict)
    for (u, w), c in two.items():
        after[u][w] = c
    weight = {u: (1 - sum(given(c, second) for c in f.values()) / sum(f.values())) / (1 - sum(map(alone, f)))
              for u, f in after.items()}

    def p(u, w):
        if u not in after:
            return alone(w)
        return given(after[u][w], second) / sum(after[u].values()) if w in after[u] else weight[u] * alone(w)

    for u in list(after)[:20]:  # each context's distribution sums to one
        assert sum(p(u, w) for w in one) + weight[u] * unknown == pytest.approx(1)
    return [(i, h, len(t), sum(w in one for w in t), n, sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t),
             sum(math.log10(p(u, w)) for u, w in zip([b" start", *t], t))) for (i, t), h in zip(tokens, held, strict=True)]


def same(rows, want):
    order = lambda r: (str(r[0]), r[2], r[5])
    rows, want = sorted(map(tuple, rows), key=order), sorted(want, key=order)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    assert [x for r in rows for x in r[5:]] == pytest.approx([x for w in want for x in w[5:]], abs=1e-6)


def test_registered_query(spark, sf_dir, texts):
    rows = queries.QUERIES["op6_katz"](spark, sf_dir).collect()
    same(rows, plain(texts))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_many_chunks_buckets_and_frequent_words(spark, texts, monkeypatch):
    for name, value in (("CHUNK_TOKENS", 2000), ("CHUNK_DOCS", 7), ("BUCKET_TOKENS", 9000), ("PIECE", 50)):
        monkeypatch.setattr(katz, name, value)
    frame = spark.createDataFrame(texts[:120], "doc_id long, text string").repartition(4)
    same(katz.score(frame).collect(), plain(texts[:120]))


def test_edge_rows(spark, edge_docs):
    same(katz.score(edge_docs).collect(), plain([(r["doc_id"], r["text"]) for r in edge_docs.collect()]))
    assert katz.score(edge_docs.limit(0)).count() == 0


def test_only_held_out_rows(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    frame = spark.createDataFrame([(i, "some words here") for i in ids], "doc_id long, text string")
    same(katz.score(frame).collect(), plain([(i, "some words here") for i in ids]))
