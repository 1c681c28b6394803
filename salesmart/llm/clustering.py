"""Centroid clustering with exact integer arithmetic; distance bounds spare most of the work of a round.

Vectors are written once, in blocks, to a table bucketed by block. What a
round knows of each vector (cluster, an upper bound of the distance to its
centroid, a lower bound of the distance to all others) is a small table with
the same buckets, so the join of both needs no shuffle and no round rewrites
the vectors. Only the sums of vectors that changed their cluster go back to
the driver: one number for each centroid and component.

When centroids move, a lower bound must be loosened. The plain way is by the
full drift of the farthest moved centroid. Here the vectors of a cluster lie
in a sphere around their old centroid, as wide as their largest upper bound.
For a centroid that moved by d, the distance of a point x to it shrinks by at
most d cos t, where t is the angle at the middle of the way between the
direction of the way and x: |x - a| - |x - b| is 2 d x1 / (|x - a| + |x - b|)
for the component x1 along the way, and the two lengths add up to at least
2 |x - middle|. The greatest cosine over the sphere is found in the plane of
the way and the sphere's centre. A sphere beside or behind the way loosens
its bounds by less, and by nothing or less than nothing if the centroid
leaves. Vectors whose bounds then don't settle their cluster are compared
with all centroids exactly.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import Scratch, arrow_rows, arrow_schema

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
# Vectors of a block, and of a bucket as far as there are enough.
BLOCK_ROWS, BUCKET_ROWS, MOST_BUCKETS = 1024, 1 << 16, 1 << 16
# Rows that a task is handed at once: vectors when they are read first, blocks later.
VECTORS_AT_ONCE, BLOCKS_AT_ONCE = 2048, 8
# Components beyond this would take squared distances out of 64 bits.
MOST = 1 << 27
# Relative and absolute room for rounding in bounds; distances themselves are exact.
SLACK = 1e-9

BLOCKS = "block long, ids array<long>, data binary"
STATE = "block long, cluster binary, upper binary, lower binary, moved array<long>, radius array<double>, scanned long"
FOUND = "vec_id long, cluster int, distance long"


def usable(vector: str, dims: int) -> Column:
    """Exactly ``dims`` components, none null, NaN or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False))), F.lit(False))


def _blocks(dims: int, scale: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, parts, held = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in batches:
            values = np.floor(batch.column(1).flatten().to_numpy(zero_copy_only=False) * float(scale))
            if values.size and np.abs(values).max() > MOST:
                raise ValueError(f"a component times {scale} is beyond {MOST}: squared distances would leave 64 bits")
            ids.extend(batch.column(0).to_pylist())
            parts.append(values.astype("<i4").reshape(-1, dims))
            held += batch.num_rows
            while held >= BLOCK_ROWS:
                whole = np.concatenate(parts)
                yield pa.RecordBatch.from_pydict({"block": [block], "ids": [ids[:BLOCK_ROWS]], "data": [whole[:BLOCK_ROWS].tobytes()]}, schema)
                ids, parts, held, block = ids[BLOCK_ROWS:], [whole[BLOCK_ROWS:]], held - BLOCK_ROWS, block + 1
        if held:
            yield pa.RecordBatch.from_pydict({"block": [block], "ids": [ids], "data": [np.concatenate(parts).tobytes()]}, schema)

    return run


class Moves(NamedTuple):
    """What a round needs: centroids, how far each came, and how much the lower bounds of each cluster loosen."""
    centroids: np.ndarray
    drift: np.ndarray
    loosen: np.ndarray


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much the distance of any vector of cluster i to any other centroid can shrink, for each i.

    ``radius[i]`` bounds the distances of the cluster's vectors to ``old[i]``.
    """
    old, new = old.astype(float), new.astype(float)
    many = len(old)
    out = np.full((many, many), -np.inf)
    for j in range(many):
        way = new[j] - old[j]
        drift = math.sqrt(way @ way)
        for i in range(many):
            if i == j:
                continue
            if not drift:
                out[i, j] = 0.0
                continue
            to = old[i] - (old[j] + new[j]) / 2
            along = to @ way / drift
            beside = math.sqrt(max(0.0, (rest := to - along / drift * way) @ rest))
            far, wide = math.hypot(along, beside), float(radius[i]) * (1 + SLACK) + SLACK
            if far <= wide or (along > 0 and beside <= wide):
                cosine = 1.0  # the sphere meets the way's continuation
            else:
                lean = wide / far
                cosine = along / far * math.sqrt(1 - lean * lean) + beside / far * lean
            if cosine < 0:  # the lengths then add up to at most 2 |x - middle| + drift
                cosine *= (far - wide) / (far - wide + drift / 2)
            out[i, j] = min(drift, drift * cosine + SLACK * (1 + drift))
    return out.max(axis=1) if many > 1 else np.zeros(many)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def _scan_all(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the first of several), and bounds of the distances to it and to the next."""
    found = np.stack([squared(vectors, c) for c in centroids], axis=1)
    cluster = found.argmin(axis=1)
    rows = np.arange(len(vectors))
    upper = np.sqrt(found[rows, cluster].astype(float)) * (1 + SLACK)
    if len(centroids) == 1:
        return cluster, upper, np.full(len(vectors), np.inf)
    return cluster, upper, np.sqrt(np.partition(found, 1, axis=1)[:, 1].astype(float)) * (1 - SLACK)


def _assign(vectors: np.ndarray, row: dict, moves: Moves) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Old and new clusters of a block's vectors, their bounds, and how many were compared with all centroids."""
    if row.get("cluster") is None:
        return (np.full(len(vectors), -1), *_scan_all(vectors, moves.centroids), len(vectors))
    before = np.frombuffer(row["cluster"], "<i4").astype(np.int64)
    upper = np.frombuffer(row["upper"], "<f8") + moves.drift[before]
    lower = np.frombuffer(row["lower"], "<f8") - moves.loosen[before]
    gaps = np.array([min([math.sqrt(squared(moves.centroids[[j]], c)[0]) for j in range(len(moves.centroids)) if j != i], default=np.inf)
                     for i, c in enumerate(moves.centroids)])
    settled = np.maximum(lower, (gaps / 2 * (1 - SLACK) - SLACK)[before])
    open_ = np.flatnonzero(upper >= settled)
    own = squared(vectors[open_], moves.centroids[before[open_]])
    upper[open_] = np.sqrt(own.astype(float)) * (1 + SLACK)
    open_ = open_[upper[open_] >= settled[open_]]
    cluster = before.copy()
    if len(open_):
        cluster[open_], upper[open_], lower[open_] = _scan_all(vectors[open_], moves.centroids)
    return before, cluster, upper, lower, len(open_)


def _round(moves: Moves, dims: int, schema: pa.Schema):
    """The state of each block, and in one more row what changed in all blocks of the task."""
    many = len(moves.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved, radius, scanned = np.zeros((many, dims + 1), np.int64), np.zeros(many), 0
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["data"], "<i4").astype(np.int64).reshape(-1, dims)
                before, cluster, upper, lower, more = _assign(vectors, row, moves)
                scanned += more
                np.maximum.at(radius, cluster, upper)
                for to, sign in ((cluster, 1), (before, -1)):
                    change = np.flatnonzero((cluster != before) & (to >= 0))
                    np.add.at(moved[:, :dims], to[change], sign * vectors[change])
                    np.add.at(moved[:, dims], to[change], sign)
                yield pa.RecordBatch.from_pydict({
                    "block": [row["block"]], "cluster": [cluster.astype("<i4").tobytes()], "upper": [upper.astype("<f8").tobytes()],
                    "lower": [lower.astype("<f8").tobytes()], "moved": [None], "radius": [None], "scanned": [None]}, schema)
        yield pa.RecordBatch.from_pydict({"block": [None], "cluster": [None], "upper": [None], "lower": [None],
                                          "moved": [moved.ravel().tolist()], "radius": [radius.tolist()], "scanned": [scanned]}, schema)

    return run


def _found(moves: Moves, dims: int, schema: pa.Schema):
    """Cluster and squared distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["data"], "<i4").astype(np.int64).reshape(-1, dims)
                cluster = _assign(vectors, row, moves)[1]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(cluster, pa.int32()),
                                                  pa.array(squared(vectors, moves.centroids[cluster]))], schema=schema)

    return run


class Buckets:
    """Tables with one number of buckets by block below the scratch folder, known to the session while they are needed."""

    def __init__(self, scratch: Scratch, buckets: int):
        self.scratch, self.spark, self.buckets, self.paths = scratch, scratch.spark, buckets, {}

    def keep(self, df: DataFrame, name: str) -> str:
        table, path = f"{name}_{uuid.uuid4().hex}", self.scratch.path(name)
        self.paths[table] = path
        df.write.bucketBy(self.buckets, "block").option("path", path).format("parquet").saveAsTable(table)
        return table

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.scratch.drop_path(self.paths.pop(table))

    def drop_all(self) -> None:
        for table in list(self.paths):
            self.drop(table)


def _sums(spark, state: str, column: str, how) -> list:
    rows = spark.table(state).select(F.posexplode(column).alias("at", "value")).groupBy("at").agg(how(F.col("value")).alias("value"))
    return [r["value"] for r in sorted(rows.collect())]


def first_centroids(kept: DataFrame, clusters: int, scale: int, seed: int) -> np.ndarray:
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    whole = F.transform("vector", lambda x: F.floor(x * scale))
    rows = kept.select(named.alias("name"), whole.alias("whole")).orderBy("name", "whole").limit(clusters).collect()
    return np.array([r["whole"] for r in sorted(rows)], np.int64)


def cluster(vectors: DataFrame, dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            seed: int = SEED, stats: list | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector.

    Reads ``vec_id`` and ``embedding``; a component x counts as
    floor(scale x). Vectors that are null, of another length, or hold null or
    non-finite components are left out. Null ids and repeated rows are
    clustered like any other (a null id is named by the seed alone); equal
    distances go to the smaller number; with fewer vectors than clusters
    there are fewer clusters; an empty table gives no rows. Components beyond
    2 ** 27 raise an error, as squared distances would leave 64 bits.
    ``stats``, if given, gets (round, vectors compared with all centroids).
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "clusters")
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
            .where(usable("vector", dims)))
    centroids = first_centroids(kept, clusters, scale, seed)
    many = len(centroids)
    empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not many:
        return spark.createDataFrame([], empty)
    with arrow_rows(spark, VECTORS_AT_ONCE):
        blocks = scratch.keep(kept.mapInArrow(_blocks(dims, scale, arrow_schema(BLOCKS)), BLOCKS), "blocks")
    rows = blocks.agg(F.sum(F.size("ids"))).first()[0]
    buckets = Buckets(scratch, min(MOST_BUCKETS, max(-(-rows // BUCKET_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // BLOCK_ROWS)))))
    try:
        with arrow_rows(spark, BLOCKS_AT_ONCE):
            table = buckets.keep(blocks.repartition(buckets.buckets, "block"), "blocks")
            scratch.drop(blocks)
            state, totals = None, np.zeros((many, dims + 1), object)
            moves = Moves(centroids, np.zeros(many), np.zeros(many))
            joined = lambda: spark.table(table) if state is None else spark.table(table).join(
                spark.table(state).select("block", "cluster", "upper", "lower").hint("shuffle_hash"), "block")
            for number in range(rounds):
                after = buckets.keep(joined().drop("ids").mapInArrow(_round(moves, dims, arrow_schema(STATE)), STATE), "state")
                if state:
                    buckets.drop(state)
                state = after
                totals = totals + np.array([int(v) for v in _sums(spark, state, "moved", lambda c: F.sum(c.cast("decimal(38,0)")))],
                                           object).reshape(many, dims + 1)
                radius = np.array(_sums(spark, state, "radius", F.max))
                if stats is not None:
                    stats.append((number, spark.table(state).agg(F.sum("scanned")).first()[0]))
                moved = np.array([[int(s) // int(row[dims]) for s in row[:dims]] if row[dims] else old.tolist()
                                  for row, old in zip(totals, moves.centroids, strict=True)], np.int64)
                drift = np.sqrt([float(squared(moved[[i]], moves.centroids[i])[0]) for i in range(many)]) * (1 + SLACK)
                moves = Moves(moved, drift, loosening(moves.centroids, moved, radius))
                if not drift.any():
                    break
            found = scratch.keep(joined().mapInArrow(_found(moves, dims, arrow_schema(FOUND)), FOUND), "found")
    finally:
        buckets.drop_all()
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in moves.centroids.tolist()]
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    return found.select("vec_id", "cluster", "distance", of([sums.get(i, 0) for i in range(many)]).cast("long").alias("cluster_inertia"),
                        F.lit(sum(sums.values())).cast("long").alias("inertia"), of(names).alias("centroid_sha256"))
