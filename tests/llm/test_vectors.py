"""Links between vectors against all pairs."""

import duckdb
import numpy as np
import pytest

from salesmart.llm import queries, vectors
from salesmart.llm.components import merge_labels


def plain(ids, raw):
    units = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    linked = units @ units.T >= vectors.LEAST_COSINE
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    merge_labels(label, *np.nonzero(linked))
    return {int(i): (int(n), int(ids[r])) for i, n, r in zip(ids, linked.sum(axis=1), label, strict=True)}


def found(frame):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in frame.collect()}


def test_registered_query_matches_all_pairs(spark, sf_dir):
    rows = duckdb.sql(f"select vec_id, embedding from '{sf_dir}/embeddings.parquet' order by 1").fetchall()
    want = plain(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))
    assert found(queries.QUERIES["op4_vectors"](spark, sf_dir)) == want


def clusters(n, dims, seed):
    random = np.random.default_rng(seed)
    centers = random.normal(size=(n // 10, dims))
    near = np.repeat(centers[: n // 20], 8, axis=0)
    near = near + random.normal(size=near.shape) * 0.15 * np.linalg.norm(near, axis=1, keepdims=True) / dims ** 0.5
    return np.concatenate([random.normal(size=(n, dims)), centers, near, near[:20]]).astype(np.float32)


@pytest.fixture(scope="module")
def planted(spark):
    raw = clusters(1200, 32, 4)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<float>")
    return raw, frame


@pytest.mark.parametrize("blocks", [False, True])
def test_recall_on_planted_clusters(planted, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(vectors, "MEMBER_BLOCK", 16)
        monkeypatch.setattr(vectors, "QUERY_BLOCK", 64)
    raw, frame = planted
    want, got = plain(np.arange(len(raw)), raw.astype(float)), found(vectors.near_duplicates(frame))
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values()) > 0


def test_code_bound_never_hides_a_link(planted):
    raw, _ = planted
    units = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    index = vectors.Index(units[::2].astype(float), 20)
    own, codes, error = index.encode(units)
    for of_list in range(20):
        mine = own == of_list
        about = index.scores(units[:50], of_list, codes[mine])
        assert (np.abs(about - units[:50] @ units[mine].T) <= error[mine] + 1e-6).all()


def test_edge_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, [1.0, 0.0, 0.0]), (9, []), (1, [1.0, 0.0]), (10, [0.0, 1.0]), (11, [-0.0, 1.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, n_links string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(frame).collect()), key=str)
    want = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    want += [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (None, 3, 1, False), (10, 1, 10, True), (11, 1, 10, False)]
    assert got == sorted(want, key=str)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_a_cluster_over_many_lists_loses_no_link(spark):
    """A third of the vectors in one cluster of different ones, spread over more lists than a few nearest."""
    random = np.random.default_rng(9)
    center = random.normal(size=64)
    hot = center + random.normal(size=(1500, 64)) * 0.19 * np.linalg.norm(center) / 8
    raw = np.concatenate([hot, random.normal(size=(3000, 64))])
    units = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    index = vectors.Index(units, 256)
    own, _, _ = index.encode(units)
    probes = [set(p) for p in index.probes(units, own, (2 - 2 * vectors.LEAST_COSINE) ** 0.5)]
    a, b = np.nonzero(units[:1500] @ units[:1500].T >= vectors.LEAST_COSINE)
    assert len(set(own[:1500])) > 32 and len(a) > 100_000
    assert all(own[j] in probes[i] for i, j in zip(a, b, strict=True))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<double>")
    assert found(vectors.near_duplicates(frame)) == plain(np.arange(len(raw)), raw)
