"""op12 against plain rounds over all distances, against its SQL twin, and its bounds against sampled spheres."""

import hashlib
import math

import numpy as np
import pytest

from checks.compare import compare, oracle_connection
from salesmart.llm import clustering
from salesmart.llm.queries import ORACLE, QUERIES


def plain(rows, dims, clusters, rounds, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for turn in range(rounds + 1):
        own = [min(range(len(centroids)), key=lambda k: (far(v, centroids[k]), k)) for _, v in kept]
        if turn < rounds:
            for k in range(len(centroids)):
                if mine := [v for (_, v), o in zip(kept, own, strict=True) if o == k]:
                    centroids[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    distance = [far(v, centroids[o]) for (_, v), o in zip(kept, own, strict=True)]
    inertia = [sum(d for d, o in zip(distance, own, strict=True) if o == k) for k in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted([(i, o, d, inertia[o], sum(distance), sha[o]) for (i, _), o, d in zip(kept, own, distance, strict=True)], key=key)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance string")


def groups(seed, many, dims, centres, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims)) * 3
    return [(i, (middle[i % centres] + rng.normal(size=dims) * spread).tolist()) for i in range(many)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_plain_rounds(spark, seed):
    rows = groups(seed, 300, 5, 4, spread=1.5)
    assert got(clustering.cluster(frame(spark, rows), 5, 6, 7)) == plain(rows, 5, 6, 7)


def test_several_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 16)
    rows = groups(4, 500, 4, 3, spread=1.0)
    assert got(clustering.cluster(frame(spark, rows).repartition(5), 4, 8, 10)) == plain(rows, 4, 8, 10)


def test_odd_vectors_ties_and_repeated_rows(spark):
    rows = [(1, None), (2, [1.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (None, [0.5, 0.5]),
            (7, [0.0, 0.0]), (7, [0.0, 0.0]), (7, [-1.0, 0.0009]), (8, [1e-300, -1e-300]), (9, [3.0, 3.0]), (None, None)]
    rows += [(i, [0.25, 0.25]) for i in range(20, 50)]
    assert got(clustering.cluster(frame(spark, rows), 2, 3, 4)) == plain(rows, 2, 3, 4)


def test_fewer_vectors_than_clusters_one_cluster_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    assert got(clustering.cluster(frame(spark, rows), 2, 8, 3)) == plain(rows, 2, 8, 3)
    assert got(clustering.cluster(frame(spark, rows), 2, 1, 3)) == plain(rows, 2, 1, 3)
    assert got(clustering.cluster(frame(spark, rows).limit(0), 2)) == []
    assert got(clustering.cluster(frame(spark, [(1, None)]), 2)) == []


def test_components_that_leave_64_bits_raise(spark):
    with pytest.raises(Exception, match="leave 64 bits"):
        clustering.cluster(frame(spark, [(1, [1e9, 1.0]), (2, [1.0, 1.0])]), 2, 2, 1).collect()


def test_bounds_spare_most_of_the_work_where_clusters_are_apart(spark):
    rows, stats = groups(6, 2000, 8, 8), []
    assert got(clustering.cluster(frame(spark, rows), 8, 8, 10, stats=stats)) == plain(rows, 8, 8, 10)
    assert stats[0][1] == 2000 and sum(n for _, n in stats[1:]) < 0.7 * 2000 * len(stats[1:])


def test_loosening_holds_for_points_in_the_spheres_and_is_below_full_drift():
    rng = np.random.default_rng(7)
    less = 0
    for _ in range(200):
        dims = int(rng.integers(2, 6))
        old = rng.integers(-1000, 1000, (4, dims))
        new = old + rng.integers(-300, 300, (4, dims)) * rng.integers(0, 2, (4, 1))
        radius = rng.uniform(0, 600, 4)
        found = clustering.loosening(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(axis=1))
        for i in range(4):
            way = rng.normal(size=(400, dims))
            points = old[i] + way / np.linalg.norm(way, axis=1, keepdims=True) * radius[i] * rng.uniform(0, 1, (400, 1)) ** 0.2
            others = [j for j in range(4) if j != i]
            shrunk = max((np.linalg.norm(points - old[j], axis=1) - np.linalg.norm(points - new[j], axis=1)).max() for j in others)
            assert shrunk <= found[i]
            assert found[i] <= drift[others].max() + 1e-6
            less += found[i] < 0.9 * drift[others].max()
    assert less > 200  # of 800


def test_no_shuffle_of_vectors_in_a_round(spark, monkeypatch):
    plans = []
    keep = clustering.Buckets.keep

    def spy(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, name)

    monkeypatch.setattr(clustering.Buckets, "keep", spy)
    clustering.cluster(frame(spark, groups(8, 400, 3, 5, spread=1.0)), 3, 4, 4).collect()
    assert len(plans) > 2
    for plan in plans[2:]:
        assert "Exchange" not in plan and "ShuffledHashJoin" in plan


def test_matches_its_twin(spark, sf_dir):
    ok, message = compare(spark, oracle_connection(sf_dir), "op12_clusters", QUERIES["op12_clusters"], ORACLE["op12_clusters"], sf_dir)
    assert ok, message
