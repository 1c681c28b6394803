"""Near copies by five-word shingles: candidates from SimHash classes, then min-hash bands; every link verified by exact Jaccard similarity.

Texts with the same set of shingles are one set. A set has a SimHash
fingerprint; vantage-point trees find what fingerprints within
``simhash.MAX_BITS`` bits connect (``simhash.link_fingerprints``), and the sets
of such a class are the first candidates. Two bits are too few for many texts
of similarity 0.8, so the classes' components are then looked at through bands,
which miss next to none. A set's 384 min-hashes form
``BANDS`` bands of ``BAND_ROWS``; sets that share a band are candidates. Two
sets of similarity s share none with probability (1 - s ** 6) ** 64: less than
4e-9 at 0.8; of sets that have a tenth in common, such as texts with one
common line, 0.006 % share one.

No pair leaves a group. The members of a class or band meet, with their shingles, in
blocks of bounded size; a block compares those of different components and
gives back which components its links join, fewer than it has members. After
every pass components are contracted, and only bands that still hold several
are looked at again. A large band is first cut into slices that each hold its
centre as well, which joins a group of near copies; then its main component
meets the members outside of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.llm.common import Scratch, fresh, scan
from salesmart.llm.components import connected, merge_labels
from salesmart.llm.simhash import link_fingerprints, majority, signed

SHINGLE = 5
# Least similarity of a link as a fraction, in whole numbers so that the border is exact.
LEAST_OF, LEAST_IN = 4, 5
BANDS, BAND_ROWS = 64, 6
# The turn of SimHash classes; bands follow from the next on.
CLASS_TURN = 0
# Turns up to which each round looks: SimHash classes, then bands; near copies fall together in the first few, and are then one
# component in the others.
ROUNDS = (1, 5, 21, 1 + BANDS)
# Members that meet in a block, and their shingles together; a block may hold one longer text more.
BLOCK, BLOCK_SHINGLES = 512, 2_000_000
_RANDOM = np.random.default_rng(5)
FACTORS = (_RANDOM.integers(1 << 31, size=(BANDS * BAND_ROWS, 1)) * 2 + 1).astype(np.uint32)
SHIFTS = _RANDOM.integers(1 << 32, size=(BANDS * BAND_ROWS, 1)).astype(np.uint32)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a UTF-8 text; a shorter text is one shingle, no words give none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([digest(joined)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes) + np.arange(len(words))
    starts, ends = (ends - sizes)[:1 - SHINGLE].tolist(), ends[SHINGLE - 1:].tolist()
    return np.unique(np.array([digest(joined[s:e]) for s, e in zip(starts, ends, strict=True)], np.uint64))


def bands(found: np.ndarray) -> list[int]:
    """Keys of the bands of a set of shingles; an empty set has none."""
    if not len(found):
        return []
    low = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    least = np.concatenate([(low * FACTORS[at:at + 8] + SHIFTS[at:at + 8]).min(axis=1)
                            for at in range(0, len(FACTORS), 8)]).reshape(BANDS, BAND_ROWS)
    return [signed(xxhash.xxh64_intdigest(row.tobytes(), seed)) for seed, row in enumerate(least)]


def _join_components(block: pa.Table) -> pa.Table:
    """(a, b): links between components that the block's members prove, a forest; members of one component aren't compared."""
    comps, at = np.unique(block.column("comp").to_numpy(), return_inverse=True)
    sets = [np.frombuffer(s, "<u8") for s in block.column("shingles").to_pylist()]
    label, n = np.arange(len(comps)), np.array([len(s) for s in sets], np.int64)
    _, word = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n)[np.argsort(word, kind="stable")]
    many = np.bincount(word)
    first, ends = np.cumsum(many) - many, np.cumsum(n)
    for i in range(len(sets)):
        other = (label[at] != label[at[i]]) & (np.minimum(n, n[i]) * LEAST_IN >= np.maximum(n, n[i]) * LEAST_OF)
        if not other.any():
            continue
        mine = word[ends[i] - n[i]:ends[i]]
        runs = many[mine]
        places = np.repeat(first[mine] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        both = np.bincount(owner[places], minlength=len(sets))
        hit = np.flatnonzero(other & (both * LEAST_IN >= (n + n[i] - both) * LEAST_OF))
        merge_labels(label, np.full(len(hit), at[i]), at[hit])
    joined = label != np.arange(len(comps))
    return pa.table({"a": comps[joined], "b": comps[label[joined]]})


class Components:
    """The component of every set so far, contracted after each pass over classes or bands."""

    def __init__(self, arrays: DataFrame, members: DataFrame, scratch: Scratch):
        self.arrays, self.members, self.scratch = arrays, members, scratch
        self.named = scratch.keep(members.select("id").distinct().withColumn("comp", F.col("id")), "components")

    def open_members(self, low: int, high: int) -> DataFrame:
        """turn, band, id, n and comp of the members of turns ``low`` to ``high`` whose bands hold more than one component."""
        now = self.members.where(f"turn >= {low} and turn < {high}").join(self.named, "id")
        still = now.groupBy("turn", "band").agg(F.min("comp").alias("one"), F.max("comp").alias("two")).where("one <> two")
        return self.scratch.keep(now.join(still.select("turn", "band"), ["turn", "band"]), "open")

    def add(self, dealt: DataFrame) -> None:
        """Let the blocks ``dealt(turn, band, x, y, id, comp)`` compare their members, and contract what they join."""
        blocks = dealt.join(self.arrays, "id").select("turn", "band", "x", "y", "comp", "shingles")
        found = self.scratch.keep(blocks.groupBy("turn", "band", "x", "y").applyInArrow(_join_components, "a long, b long"), "joined")
        parts = connected(found, self.scratch)
        after = (self.named.join(parts.withColumnRenamed("node", "comp"), "comp", "left")
                 .select("id", F.coalesce("component", "comp").alias("comp")))
        after = self.scratch.keep(after, "components")
        self.scratch.drop(self.named)
        self.scratch.drop(found)
        self.named = after


def _slices(rows: str, shingles: str) -> Column:
    return F.greatest(F.ceil(F.col(rows) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.lit(1)).cast("int")


def _slice(many: str) -> Column:
    return F.pmod(F.xxhash64("id"), F.col(many)).cast("int")


def _upto(many: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(many) - 1))


def components(arrays: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, comp) of the sets that share classes or bands, from ``members(turn, band, id, n)`` and their shingles ``arrays(id, shingles)``."""
    work, band = Components(arrays, members, scratch), ["turn", "band"]
    for low, high in zip((0, *ROUNDS[:-1]), ROUNDS, strict=True):
        still = work.open_members(low, high)
        size = still.groupBy(*band).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("all_n"),
                                        F.min(F.struct(F.xxhash64("id").alias("by"), "id", "comp")).alias("c"))
        size = scratch.keep(size.select(*band, _slices("rows", "all_n").alias("slices"), "c"), "bands")
        own = still.join(size, band).select(*band, _slice("slices").alias("x"), F.lit(0).alias("y"), "id", "comp")
        centres = size.where("slices > 1").select(*band, _upto("slices").alias("x"), F.lit(0).alias("y"), F.col("c.id").alias("id"),
                                                  F.col("c.comp").alias("comp"))
        work.add(own.union(centres).distinct())
        large = size.where("slices > 1").select(*band)
        if large.isEmpty():
            continue
        # what a large band has besides its main component meets that, and itself
        still = scratch.keep(work.open_members(low, high).join(large, band), "open")
        per = still.groupBy(*band, "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("all_n"))
        main = F.max(F.struct("rows", "comp", "all_n"))
        size = per.groupBy(*band).agg(main.alias("m"), F.sum("rows").alias("rows"), F.sum("all_n").alias("all_n"))
        size = size.select(*band, F.col("m.comp").alias("main"), F.col("m.rows").alias("main_rows"), F.col("m.all_n").alias("main_n"),
                           (F.col("rows") - F.col("m.rows")).alias("rows"), (F.col("all_n") - F.col("m.all_n")).alias("all_n"))
        size = scratch.keep(size.select(*band, "main", _slices("main_rows", "main_n").alias("a"), _slices("rows", "all_n").alias("b")), "bands")
        both = still.join(size, band)
        inside, outside = both.where("comp = main"), both.where("comp <> main")
        columns = ["id", "comp"]
        first = inside.select(*band, _slice("a").alias("x"), _upto("b").alias("y"), *columns)
        second = outside.select(*band, _upto("a").alias("x"), _slice("b").alias("y"), *columns)
        third = outside.where("b > 1").select(*band, _slice("b").alias("p"), _upto("b").alias("q"), *columns)
        third = third.select(*band, (-1 - F.least("p", "q")).alias("x"), F.greatest("p", "q").alias("y"), *columns)
        work.add(first.union(second).union(third))
    return work.named


def simhash_classes(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """turn, band, id and n of the sets with shingles: the band is the least fingerprint that theirs reaches by links."""
    some = sets.where("n > 0")
    distinct = scratch.keep(some.select("fp").distinct(), "fingerprints")
    found = connected(link_fingerprints(distinct, scratch), scratch).withColumnRenamed("node", "fp")
    return some.join(found, "fp", "left").select(F.lit(CLASS_TURN).alias("turn"), F.coalesce("component", "fp").alias("band"), "id", "n")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when each class of near copies keeps one: the least doc_id, nulls last.

    A class is what links of Jaccard similarity 0.8 or more over five-word
    shingles connect. Texts without words, null ones too, are one class; of
    rows equal in doc_id and text, one stays; an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "near_copies")

    def work(columns: dict[str, list]) -> dict[str, list]:
        found = [shingles(t) for t in columns["text"]]
        return {"doc_id": columns["doc_id"], "text_hash": columns["text_hash"], "n": [len(f) for f in found],
                "key_a": [signed(xxhash.xxh64_intdigest(f.tobytes())) for f in found],
                "key_b": [signed(xxhash.xxh64_intdigest(f.tobytes(), 1)) for f in found], "bands": [bands(f) for f in found],
                "fp": [signed(majority(f)) for f in found]}

    def array(columns: dict[str, list]) -> dict[str, list]:
        return {"id": columns["id"], "shingles": [shingles(t).astype("<u8").tobytes() for t in columns["text"]]}

    key = ["key_a", "key_b"]  # 128 bits name a set
    narrow = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_hash"))
    read = scratch.keep(scan(narrow, work, "doc_id long, text_hash long, n long, key_a long, key_b long, bands array<long>, fp long"), "signatures")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    sets = read.groupBy(*key).agg(F.min(row).alias("first"), F.min("n").alias("n"), F.any_value("bands").alias("bands"),
                                  F.any_value("fp").alias("fp"))
    sets = scratch.keep(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    scratch.drop(read)
    each = sets.select("id", "n", F.posexplode("bands").alias("turn", "band")).select(
        (F.col("turn") + CLASS_TURN + 1).alias("turn"), "band", "id", "n")
    each = each.unionByName(simhash_classes(sets, scratch))
    shared = each.groupBy("turn", "band").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("turn", "band")
    members = scratch.keep(each.join(shared, ["turn", "band"]).select("turn", "band", "id", "n"), "members")
    first = sets.select("id", F.col("first.doc_id").alias("of"), F.col("first.text_hash").alias("of_hash"))
    asked = first.join(members.select("id").distinct(), "id")
    texts = narrow.join(asked, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")))
    arrays = scratch.keep(scan(texts.groupBy("id").agg(F.min("text").alias("text")), array, "id long, shingles binary"), "arrays")
    named = components(arrays, members, scratch)

    winners = (sets.join(named, "id", "left").groupBy(F.coalesce("comp", "id").alias("comp")).agg(F.min("first").alias("first")))
    key, other = fresh(docs, "_key", "_other")
    winners = scratch.keep(winners.select(F.col("first.doc_id").alias(key), F.col("first.text_hash").alias(other)), "winners")
    for table in (sets, members, arrays, named):
        scratch.drop(table)
    # texts meet the winners once; of rows equal in doc_id and text one stays, which each map task applies first
    hashed, place = fresh(docs, "_text_hash", "_place")
    matched = docs.withColumn(hashed, F.xxhash64("text")).join(
        winners, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(hashed) == F.col(other)), "left_semi")
    again = F.row_number().over(Window.partitionBy("doc_id", hashed).orderBy(hashed))
    return matched.withColumn(place, again).where(F.col(place) == 1).select(*docs.columns)
