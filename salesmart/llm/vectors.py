"""Embedding near-duplicates: inverted lists, product-quantised residuals, table-lookup scores, exact rerank.

Coarse centroids and codebooks are fitted on a bounded sample; every vector
is indexed. A vector looks into the lists that may hold a partner: a list
whose border with the vector's own list is farther than the link distance
can't. Partners seldom lie straight across a border, so in many dimensions a
fraction of the distance finds nearly all links: the fraction is fitted to the
sample (``Index.reach``), and 1 is the exact way. In a list, a member's code
gives its cosine up to the length of its coding error, which is stored, so no
link is lost to the codes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import Scratch, scan
from salesmart.llm.components import connected, merge_labels

LEAST_COSINE = 0.95
# Vectors that centroids and codebooks are fitted on, lists at most.
SAMPLE, MOST_LISTS = 20_000, 4096
SUBSPACES, CODES, ROUNDS = 8, 256, 8
# Sampled vectors that the reach is fitted on, drawn partners of each, the share of links that it has to find, and its margin.
REACH_SAMPLE, PARTNERS, REACH_SHARE, REACH_MARGIN = 2048, 8, 0.999, 1.5
# Members and queries that meet in one group; larger lists are split into blocks of both.
MEMBER_BLOCK, QUERY_BLOCK, STEP = 2048, 8192, 256


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    half = 0.5 * (centers * centers).sum(axis=1)
    for at in range(0, len(points), 4096):
        out[at:at + 4096] = (half - points[at:at + 4096] @ centers.T).argmin(axis=1)
    return out


def k_means(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centers after ``ROUNDS`` rounds from a seeded start; an empty one keeps its place."""
    random = np.random.default_rng(seed)
    centers = points[random.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centers)
        counts = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centers


class Index:
    """Centroids of the lists and codebooks of the residuals' subspaces."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centroids = k_means(sample, lists, 1)
        residuals = sample - self.centroids[nearest(sample, self.centroids)]
        parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.spans = [(int(p[0]), int(p[-1]) + 1) for p in parts]
        self.books = [k_means(residuals[:, a:b], CODES, 2 + i) for i, (a, b) in enumerate(self.spans)]

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own list, codes and length of the coding error of each unit vector."""
        own = nearest(units, self.centroids)
        residuals = units - self.centroids[own]
        codes = np.stack([nearest(residuals[:, a:b], book) for (a, b), book in zip(self.spans, self.books)], axis=1)
        coded = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1)
        return own, codes.astype(np.uint8), np.linalg.norm(residuals - coded, axis=1)

    def probes(self, units: np.ndarray, own: np.ndarray, distance: float) -> list[list[int]]:
        """The lists of each vector without those whose border with its own is beyond ``distance``; the bound is exact."""
        out, norms = [], (self.centroids * self.centroids).sum(axis=1)
        for at in range(0, len(units), STEP):
            some, mine = units[at:at + STEP], own[at:at + STEP]
            squares = norms - 2 * some @ self.centroids.T
            over = squares - squares[np.arange(len(some)), mine][:, None]
            apart = norms[mine][:, None] + norms - 2 * self.centroids[mine] @ self.centroids.T
            may = over <= 2 * np.sqrt(np.maximum(apart, 0.0) + 1e-12) * distance + 1e-9
            may[np.arange(len(some)), mine] = True
            out += [np.flatnonzero(row).tolist() for row in may]
        return out

    def reach(self, sample: np.ndarray, least: float) -> float:
        """The fraction of the link distance that finds more than ``REACH_SHARE`` of links at the border cosine ``least``.

        Fitted on the links within a part of the sample, and on partners drawn
        around it at cosine ``least`` in any direction; the larger counts,
        times ``REACH_MARGIN``.
        """
        some = sample[:REACH_SAMPLE]
        random, distance = np.random.default_rng(4), (2 - 2 * least) ** 0.5
        norms, needed = (self.centroids * self.centroids).sum(axis=1), [0.0]

        def fractions(units: np.ndarray, partners: np.ndarray) -> np.ndarray:
            mine, theirs, rows = nearest(units, self.centroids), nearest(partners, self.centroids), np.arange(len(units))
            over = norms[theirs] - norms[mine] - 2 * np.einsum("ij,ij->i", units, self.centroids[theirs] - self.centroids[mine])
            apart = np.linalg.norm(self.centroids[theirs] - self.centroids[mine], axis=1)
            across = (mine != theirs) & (apart > 0)
            out = np.zeros(len(rows))
            out[across] = over[across] / (2 * apart[across] * distance)
            return out

        for _ in range(PARTNERS):
            aside = random.normal(size=some.shape)
            aside -= np.einsum("ij,ij->i", aside, some)[:, None] * some
            length = np.linalg.norm(aside, axis=1, keepdims=True)
            if not (length > 0).all():  # one component: no aside
                return 1.0
            needed.append(np.quantile(fractions(some, least * some + (1 - least * least) ** 0.5 * aside / length), REACH_SHARE))
        for at in range(0, len(some), STEP):
            q, m = np.nonzero(some[at:at + STEP] @ some.T >= least)
            if len(q):
                needed.append(np.quantile(fractions(some[at + q], some[m]), REACH_SHARE))
        return float(min(1.0, max(needed) * REACH_MARGIN + 1e-6))

    def scores(self, queries: np.ndarray, of_list: int, codes: np.ndarray) -> np.ndarray:
        """Approximate cosines of queries with coded members of a list, by table look-up."""
        out = np.repeat((queries @ self.centroids[of_list])[:, None], len(codes), axis=1)
        for i, ((a, b), book) in enumerate(zip(self.spans, self.books, strict=True)):
            out += (queries[:, a:b] @ book.T)[:, codes[:, i]]
        return out


def unit_rows(flat: list[bytes], dims: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(flat), f"<f{len(flat[0]) // dims}").astype(np.float64).reshape(-1, dims)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: str = "embedding") -> Column:
    """True for vectors that can have a cosine: no null, all finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _keys(vector: str = "embedding") -> list[Column]:
    plain = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))  # one form of zero
    return [F.xxhash64(plain).alias("key_a"), F.xxhash64(F.lit("b"), plain).alias("key_b")]


def link_blocks(distinct: DataFrame, dims: int, scratch: Scratch, least: float, reach: float | None, single: bool) -> DataFrame:
    """(id, links, root) partial results of all distinct vectors with ``dims`` components.

    links is a number of linked rows, root the least id of a forest that the
    block's links span. A query meets each list that it looks into in
    ``MEMBER_BLOCK`` blocks of it; no pair leaves its block.
    """
    rows = distinct.where(F.size("vector") == dims)
    count = rows.count()
    share = min(1.0, SAMPLE / max(1, count))
    sample = rows.where(F.pmod(F.xxhash64("key_a"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("vector")
    points = np.array([r[0] for r in sample.toLocalIterator()], np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = Index(points, int(min(MOST_LISTS, max(1, count ** 0.5))))
    distance = (2 - 2 * least) ** 0.5 * (index.reach(points, least) if reach is None else reach)
    stored = "<f4" if single else "<f8"

    def encode(columns: dict[str, list]) -> dict[str, list]:
        raw = np.array(columns["vector"], "<f8")
        units = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        own, codes, errors = index.encode(units)
        return {"id": columns["id"], "rows": columns["rows"], "raw": [r.tobytes() for r in raw.astype(stored)], "list": own,
                "codes": [c.tobytes() for c in codes], "error": errors, "probes": index.probes(units, own, distance)}

    coded = scratch.keep(scan(rows.select("id", "rows", "vector"), encode,
                              "id long, rows long, raw binary, list int, codes binary, error double, probes array<int>"),
                         f"coded-{dims}")
    # At most MOST_LISTS rows each: how many blocks of members and of queries a list has.
    members = dict(tuple(r) for r in coded.groupBy("list").count().collect())
    queries = dict(tuple(r) for r in coded.select(F.explode("probes").alias("list")).groupBy("list").count().collect())
    blocks = {k: (-(-n // MEMBER_BLOCK), -(-queries.get(k, 1) // QUERY_BLOCK)) for k, n in members.items()}

    def deal(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("list", "mb", "qb", "id", "rows", "raw", "codes", "error")}

        def put(*values) -> None:
            for name, value in zip(out, values, strict=True):
                out[name].append(value)

        for at, (id_, own) in enumerate(zip(columns["id"], columns["list"], strict=True)):
            many, several = blocks[own]
            for q in range(several):
                put(own, id_ % many, q, id_, columns["rows"][at], columns["raw"][at], columns["codes"][at], columns["error"][at])
            for probe in columns["probes"][at]:
                many, several = blocks.get(probe, (0, 1))
                for m in range(many):
                    put(probe, m, id_ % several, id_, None, columns["raw"][at], None, None)
        return out

    def link(block: pa.Table) -> pa.Table:
        is_member = np.array(block.column("codes").is_valid())
        mine, asking = block.filter(pa.array(is_member)), block.filter(pa.array(~is_member))
        if not mine.num_rows or not asking.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        of_list = block.column("list")[0].as_py()
        members, own_ids = unit_rows(mine.column("raw").to_pylist(), dims), mine.column("id").to_numpy()
        codes = np.frombuffer(b"".join(mine.column("codes").to_pylist()), np.uint8).reshape(len(members), -1)
        error, weight = mine.column("error").to_numpy(), mine.column("rows").to_numpy()
        probing, ids = unit_rows(asking.column("raw").to_pylist(), dims), asking.column("id").to_numpy()
        names, place = np.unique(np.concatenate([own_ids, ids]), return_inverse=True)
        at_member, at_query = place[:len(own_ids)], place[len(own_ids):]
        label, links = np.arange(len(names)), np.zeros(len(names), np.int64)
        for at in range(0, len(ids), STEP):
            some = probing[at:at + STEP]
            q, m = np.nonzero(index.scores(some, of_list, codes) + error >= least - 1e-6)
            exact = (some @ members.T)[q, m] >= least
            q, m = q[exact] + at, m[exact]
            other = ids[q] != own_ids[m]
            q, m = q[other], m[other]
            np.add.at(links, at_query[q], weight[m])
            merge_labels(label, at_query[q], at_member[m])
        told = (links > 0) | (label != np.arange(len(names)))
        return pa.table({"id": names[told], "links": links[told], "root": names[label[told]]})

    dealt = scan(coded, deal, "list int, mb int, qb int, id long, rows long, raw binary, codes binary, error double")
    return dealt.groupBy("list", "mb", "qb").applyInArrow(link, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, reach: float | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors(vec_id, embedding)``.

    ``reach`` is the fraction of the link distance within which a list's
    border is crossed: fitted by default, 1 loses no link.
    Rows with equal vectors are one vector with a number of rows in the index
    and link with each other. Null, zero and unusable vectors link with
    nothing and are their own component; only vectors of equal length are
    compared; a null vec_id never names a component unless all of it are null;
    an empty table gives none.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), usable().alias("good"))
    good = rows.where("good").select("vec_id", "vector", *_keys("vector"))
    distinct = good.groupBy("key_a", "key_b").agg(F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("first_id"),
                                                  F.any_value("vector").alias("vector"))
    distinct = scratch.keep(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct")
    lengths = [r[0] for r in distinct.select(F.size("vector")).distinct().collect()]
    found = None
    for dims in sorted(lengths):
        part = link_blocks(distinct, dims, scratch, least, reach, single)
        found = part if found is None else found.union(part)
    narrow = distinct.select("id", "key_a", "key_b", "rows", "first_id")
    if found is None:
        named = narrow.withColumn("links", F.lit(0)).withColumn("component_id", F.col("first_id"))
    else:
        found = scratch.keep(found, "found")
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        parts = connected(found.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
        parts = parts.join(narrow.select(F.col("id").alias("node"), "first_id"), "node")
        least_ids = parts.groupBy("component").agg(F.min("first_id").alias("least_id"))
        parts = parts.join(least_ids, "component").select(F.col("node").alias("id"), "least_id")
        named = (narrow.join(links, "id", "left").join(parts, "id", "left")
                 .withColumn("component_id", F.coalesce("least_id", "first_id")))
    named = scratch.keep(named.select("key_a", "key_b", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
                                      "component_id"), "named")
    linked = good.select("vec_id", "key_a", "key_b").join(named, ["key_a", "key_b"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
