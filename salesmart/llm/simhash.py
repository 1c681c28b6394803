"""SimHash near-duplicates: vantage-point trees deal fingerprints into shards that overlap at their borders.

Two fingerprints within ``2 * reach`` bits have a word between them within
``reach`` of both. That word has one shard; by the triangle bound both
fingerprints reach it when each goes down every branch that a ball of
``reach`` around it touches. So each link shows in at least one shard and no
pair is looked for across shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from salesmart.llm.common import Scratch, fresh, scan
from salesmart.llm.components import connected, merge_labels

SHINGLE, SEED, MAX_BITS = 3, 42, 2
# Fingerprints a shard aims at, and sampled fingerprints per shard that place the borders.
SHARD_ROWS, SAMPLE_PER_SHARD, MOST_SHARDS = 2048, 16, 1 << 16
LOCAL_LEAF, BLOCK = 384, 512


def fingerprint(text: bytes | None) -> int:
    """The 64-bit fingerprint of a UTF-8 text; no words give zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes) + np.arange(len(words))
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    starts, ends = (ends - sizes)[:1 - SHINGLE].tolist(), ends[SHINGLE - 1:].tolist()
    return majority(np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are those set in over half of 64-bit ``hashes``; none give zero."""
    hashes, counts = hashes.astype("<u8", copy=False), np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed 64 bits) and text_hash of every row."""
    def work(columns: dict[str, list]) -> dict[str, list]:
        return {"doc_id": columns["doc_id"], "text_hash": columns["text_hash"],
                "fp": [signed(fingerprint(t)) for t in columns["text"]]}
    narrow = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_hash"))
    return scan(narrow, work, "doc_id long, text_hash long, fp long")


def build_tree(sample: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a tree in heap order; a node's inner child holds distances up to its radius.

    The vantage point is the candidate whose distances spread the most, the
    radius is near the median where the fewest sampled distances lie on the border.
    """
    points, radii = np.zeros(1 << levels, np.uint64), np.full(1 << levels, 64, np.int64)
    members = {1: np.sort(sample)}
    for node in range(1, 1 << levels):
        own = members.pop(node, np.zeros(0, np.uint64))
        if len(own) < 4:
            continue
        candidates = own[:: max(1, len(own) // 8)][:8]
        distances = np.bitwise_count(candidates[:, None] ^ own[None, :]).astype(np.int64)
        best = int(np.argmax(distances.std(axis=1)))
        far = distances[best]
        counts = np.bincount(far, minlength=67)
        below = np.cumsum(counts) / len(own)
        border = np.array([counts[r] + counts[r + 1] for r in range(66)]) / len(own)
        cost = border + 2 * np.abs(below[:66] - 0.5)
        radius = int(np.argmin(cost))
        if below[radius] in (0.0, 1.0):
            continue
        points[node], radii[node] = candidates[best], radius
        members[2 * node], members[2 * node + 1] = own[far <= radius], own[far > radius]
    return points, radii


def shards_of(fps: np.ndarray, points: np.ndarray, radii: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) for each shard that a ball of ``reach`` around a fingerprint touches."""
    rows, nodes = np.arange(len(fps)), np.ones(len(fps), np.int64)
    for _ in range(int(np.log2(len(points)))):
        far = np.bitwise_count(fps[rows] ^ points[nodes]).astype(np.int64)
        inner, outer = far - reach <= radii[nodes], far + reach > radii[nodes]
        rows, nodes = (np.concatenate([rows[inner], rows[outer]]),
                       np.concatenate([2 * nodes[inner], 2 * nodes[outer] + 1]))
    return rows, nodes


def link_local(fps: np.ndarray, bits: int) -> np.ndarray:
    """Root position of each fingerprint of a shard; vantage-point splits until a part is small or splits badly."""
    label, reach = np.arange(len(fps)), (bits + 1) // 2
    todo = [label.copy()]
    while todo:
        part = todo.pop()
        own = fps[part]
        if len(part) > LOCAL_LEAF:
            far = np.bitwise_count(own ^ own[len(own) // 2]).astype(np.int64)
            radius = int(np.median(far))
            inner, outer = part[far - reach <= radius], part[far + reach > radius]
            if max(len(inner), len(outer)) < 0.8 * len(part):
                todo += [inner, outer]
                continue
        for at in range(0, len(part), BLOCK):
            near = np.bitwise_count(own[at:at + BLOCK, None] ^ own[None, at:]) <= bits
            i, j = np.nonzero(near)
            later = j > i
            merge_labels(label, part[at + i[later]], part[at + j[later]])
    return label


def link_fingerprints(distinct: DataFrame, scratch: Scratch, bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect what fingerprints ``distinct(fp)`` within ``bits`` of each other connect.

    Every fingerprint is compared; the sample (``SAMPLE_PER_SHARD`` for each of
    up to ``MOST_SHARDS`` shards) only places the borders. A shard returns a
    forest, not its pairs.
    """
    rows = distinct.count()
    levels = int(np.ceil(np.log2(min(MOST_SHARDS, max(2, rows / SHARD_ROWS)))))
    share = min(1.0, (SAMPLE_PER_SHARD << levels) / max(1, rows))
    sampled = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).toPandas()["fp"]
    points, radii = build_tree(sampled.to_numpy(np.int64).view(np.uint64), levels)
    reach = (bits + 1) // 2

    def deal(columns: dict[str, list]) -> dict[str, list]:
        fps = np.array(columns["fp"], np.int64)
        row, shard = shards_of(fps.view(np.uint64), points, radii, reach)
        return {"shard": shard, "fp": fps[row]}

    def link(shard: pa.Table) -> pa.Table:
        fps = np.unique(shard.column("fp").to_numpy())
        root = link_local(fps.view(np.uint64), bits)
        linked = root != np.arange(len(fps))
        return pa.table({"a": fps[linked], "b": fps[root[linked]]})

    dealt = scan(distinct.select("fp"), deal, "shard long, fp long")
    return dealt.groupBy("shard").applyInArrow(link, "a long, b long")


def class_table(docs: DataFrame, bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) of every row, and of every fingerprint its class.

    The second has fp, class_fp (the least fingerprint of the class),
    component_id (the least doc_id of the class) and first, the least row of
    the fingerprint as (no doc_id, doc_id, text_hash). Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.keep(fingerprints(docs), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.min(row).alias("first")), "distinct")
    found = connected(link_fingerprints(distinct, scratch, bits), scratch)
    linked = found.join(distinct.withColumnRenamed("fp", "node"), "node")
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    named = linked.join(least, "component").select(F.col("node").alias("fp"), "component", "least_id")
    named = distinct.join(named, "fp", "left").select("fp", F.coalesce("component", "fp").alias("class_fp"),
                                                      F.coalesce("least_id", "first_id").alias("component_id"), "first")
    # written, so that a join with it has two plain sides and Spark can split a hot one
    return prints, scratch.keep(named, "classes")


def classes(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Every row's doc_id, text_hash, fp, class_fp and component_id, the least doc_id its fingerprint reaches by links.

    One row in, one row out. Null and empty texts and texts without words have
    fingerprint zero and link like any other; repeated rows share a class; a
    null doc_id never names a class unless all of the class are null; an empty
    table gives none. Unlike component_id, class_fp also tells classes apart
    when a doc_id occurs with different texts.
    """
    prints, named = class_table(docs, bits)
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "class_fp", "component_id")


def hex_digits(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps one: the least doc_id, nulls last.

    The choice is a minimum for each fingerprint, then for each class; texts
    meet it once, in a join on doc_id and a hash of the text. Of rows equal in
    both, one stays.
    """
    key, other, text_hash, place = fresh(docs, "_key", "_other", "_text_hash", "_place")
    winners = (class_table(docs, bits)[1].groupBy("class_fp").agg(F.min("first").alias("first"))
               .select(F.col("first.doc_id").alias(key), F.col("first.text_hash").alias(other)))
    matched = docs.withColumn(text_hash, F.xxhash64("text")).join(
        winners, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(text_hash) == F.col(other)), "left_semi")
    again = F.row_number().over(Window.partitionBy("doc_id", text_hash).orderBy(text_hash))
    return matched.withColumn(place, again).where(F.col(place) == 1).select(*docs.columns)

