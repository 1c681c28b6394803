"""SimHash classes against all pairs, and components against a union of sets."""

import random

import numpy as np

from salesmart.llm import queries, simhash
from salesmart.llm.common import Scratch
from salesmart.llm.components import connected
from tests_support import plain_fingerprint, union


def test_registered_query_matches_all_pairs(spark, sf_dir, texts):
    prints = {i: plain_fingerprint(t) for i, t in texts}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = {(i, f"{prints[i]:016x}", root) for i, root in union(prints, links).items()}
    assert {tuple(r) for r in queries.QUERIES["op2_simhash"](spark, sf_dir).collect()} == want


def planted(n):
    """Random words with chains and clusters of words a few bits apart."""
    random.seed(5)
    words = [random.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        word = random.choice(words)
        for _ in range(random.randint(1, 3)):
            word ^= 1 << random.randrange(64)
        words.append(word)
    return np.unique(np.array(words, np.uint64))


def test_no_link_is_lost_at_the_borders():
    fps = planted(1500)
    points, radii = simhash.build_tree(fps[::7], 5)
    row, shard = simhash.shards_of(fps, points, radii, 1)
    found = set()
    for s in np.unique(shard):
        own = np.unique(row[shard == s])
        label = simhash.link_local(fps[own], 2)
        found |= {(int(own[i]), int(own[r])) for i, r in enumerate(label) if i != r}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    want = union(range(len(fps)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b])
    assert union(range(len(fps)), found) == want
    assert len(np.unique(shard)) > 8


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (5, 4)]
    random.seed(1)
    names = list(range(1000))
    random.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    got = connected(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    ids = {i for link in links for i in link}
    assert {r[0]: r[1] for r in got.collect()} == union(ids, links)
    assert connected(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def test_edge_rows(edge_docs):
    rows = simhash.classes(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {0}
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None).count(4) == 1
    assert simhash.keep_one(edge_docs.limit(0)).count() == 0


def test_one_of_each_class_stays_where_ids_repeat(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "A B C D"), (1, "other words are here"), (None, "a b c d")],
                                 "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.keep_one(docs).collect()) == [(1, "a b c d"), (1, "other words are here")]
