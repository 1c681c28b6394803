"""Shards of near equal bytes: longest-processing-time scheduling of groups that must stay together.

Equal texts form a group. Groups above a share of all bytes are scheduled one
by one; there are at most ``SHARE`` of them for each shard. The smaller ones
are bundled by hash into a fixed number of bundles, which are scheduled like
groups. The heap so sees a bounded list, whatever the number of documents.

The fullest shard tops the mean by less than the largest item of that list: a
large group's bytes, or a bundle's. Bundles hold a hundredth of a shard on
average, so without large groups shards differ by about a hundredth of their
bytes at most, however many small groups there are.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import Scratch, fresh
from salesmart.llm.running import with_running

SHARDS = 40
# A group is scheduled by itself above 1 / (SHARE * shards) of all bytes; bundles for each shard.
SHARE, BUNDLES = 500, 100
OVERHEAD = 16
LAW = "bytes"


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def group_of(text: str = "text") -> Column:
    """A group's key: a digest of the text; null texts form one group, apart from the empty text's."""
    return F.coalesce(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), F.lit(b""))


def bundle_of(group: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(group), F.lit(shards * BUNDLES)).cast("int")


def least_loaded(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item: items by falling size, each to the shard with the least load so far."""
    heap = [(0, shard) for shard in range(shards)]
    out = [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heapq.heappop(heap)
        out[at] = shard
        heapq.heappush(heap, (load + sizes[at], shard))
    return out


def schedule(rows: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(large groups with their shard, bundles with their shard) of ``rows(grp, size)``.

    At most ``shards * (SHARE + BUNDLES)`` rows come to the driver and are
    broadcast, however many documents there are.
    """
    spark = rows.sparkSession
    groups = rows.groupBy("grp").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    least = total // (SHARE * shards)
    large = groups.where(F.col("bytes") > least).select("grp", "bytes")
    small = (groups.where(F.col("bytes") <= least).groupBy(bundle_of(F.col("grp"), shards).alias("bundle"))
             .agg(F.sum("bytes").alias("bytes")))
    ones = sorted((bytes(r[0]), r[1]) for r in large.collect())
    many = sorted((r[0], r[1]) for r in small.collect())
    given = least_loaded([size for _, size in ones] + [size for _, size in many], shards)
    of_group = spark.createDataFrame([(k, s) for (k, _), s in zip(ones, given)], "grp binary, of_group int")
    of_bundle = spark.createDataFrame([(k, s) for (k, _), s in zip(many, given[len(ones):])], "bundle int, of_bundle int")
    return of_group, of_bundle


def with_shard(rows: DataFrame, group: str, shard: str, shards: int, parts: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``rows`` with the shard of their group, by two broadcast joins with bounded tables."""
    of_group, of_bundle = parts
    key, bundle, a, b = fresh(rows, "_key", "_bundle", "_a", "_b")
    joined = rows.join(F.broadcast(of_group.select(F.col("grp").alias(key), F.col("of_group").alias(a))),
                       F.col(group) == F.col(key), "left")
    joined = joined.join(F.broadcast(of_bundle.select(F.col("bundle").alias(bundle), F.col("of_bundle").alias(b))),
                         bundle_of(F.col(group), shards) == F.col(bundle), "left")
    return joined.withColumn(shard, F.coalesce(a, b)).drop(key, bundle, a, b)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``.

    size is the text's bytes plus ``OVERHEAD``; slots count from 0 in each
    shard without gaps. Null texts have no bytes and crc 0 and share a group;
    repeated rows share a group and take slots of their own; an empty table
    gives none. Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    rows = docs.select("doc_id", size_of().alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))
                       .cast("long").alias("text_crc32"), group_of().alias("grp"))
    rows = scratch.keep(rows.withColumn("h", F.xxhash64("doc_id", "grp")), "rows")
    placed = with_shard(rows, "grp", "shard", shards, schedule(rows, shards)).drop("grp")
    placed = with_running(placed, "shard", "h", ["doc_id", "size"], {"slot": F.lit(1)}, rows.count(), scratch)
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def row_place() -> Column:
    """Where a row lies in a table that Spark wrote: the numbers of its part file, then its row in that file.

    Files of a range-sorted table are numbered in its order, so this gives the
    order back whatever tasks read the files. Only for a frame that is such a
    table itself: behind further steps Spark gives the place in their source.
    """
    numbers = lambda group: F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-.*?(?:-c(\d+))?(?:\.[a-z]+)*$", group)
    part, piece = (F.coalesce(numbers(group).try_cast("long"), F.lit(0)) for group in (1, 2))
    return F.shiftleft(part, 43) + F.shiftleft(piece, 35) + F.col("_metadata.row_index")


def shard_rows(docs: DataFrame, shards: int = SHARDS, place: Column | None = None) -> DataFrame:
    """``docs`` with a column ``shard`` added (``_shard`` where that name is taken); texts aren't shuffled.

    With ``place``, a row's place in the training order, it is added as ``position`` (``_position`` where taken), so
    that a shard's rows can be put into that order again; ``row_place()`` where ``docs`` is a table as
    ``mixing.scheduled_copies`` was written. Equal texts, also null ones, share a shard; repeated rows keep
    places of their own; an empty table gives none.
    """
    group, size, shard, position = fresh(docs, "_group", "_size", "shard", "position")
    keyed = docs if place is None else docs.select("*", place.alias(position))
    keyed = keyed.withColumn(group, group_of()).withColumn(size, size_of())
    parts = schedule(keyed.select(F.col(group).alias("grp"), F.col(size).alias("size")), shards)
    return with_shard(keyed, group, shard, shards, parts).select(*docs.columns, shard, *([] if place is None else [position]))
