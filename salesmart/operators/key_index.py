"""Exact index of stored keys: one bit per key, in bitmaps of 32,768 neighbouring keys.

A batch's index is built from its own keys and stored beside it. To find out
which keys of a new batch are stored, the index rows of its buckets are
joined, not the stored keys: dense keys, also those that batches share out
among each other, take a bit each. A bucket with few keys keeps their places
as a list, so keys spread over a wide range don't take a bitmap each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.operators.cleaning import stored_keys_near
from salesmart.session import broadcast_if_small

KEY_INDEX = "bucket bigint, bits binary, places array<int>, id_batch string"
# A bucket with more keys than this has a bitmap (4 KiB), others a list of places.
MOST_PLACES = 1024


def _bucket(key: str) -> Column:
    return F.bitmap_bucket_number(key).alias("bucket")


def _place(key: str) -> Column:
    return F.bitmap_bit_position(key).cast("int")


def key_bitmaps(rows: DataFrame, key: str = "id_venta", scattered: bool = False) -> DataFrame:
    """Index rows of the keys in ``rows``; null keys and copies leave no trace. A bucket has 32,768 places at most.

    Sorted keys are put into bitmaps where they lie. ``scattered`` keys go to
    the task of their bucket first: each task would else send a bitmap of every bucket.
    """
    rows = rows.select(F.col(key).cast("bigint").alias("_key")).where("_key is not null").select("_key", _bucket("_key"))
    if scattered:
        rows = rows.repartition("bucket")
    found = rows.groupBy("bucket").agg(F.bitmap_construct_agg(_place("_key")).alias("bits"),
                                              F.collect_set(_place("_key")).alias("places"))
    few = F.size("places") <= MOST_PLACES
    return found.select("bucket", F.when(~few, F.col("bits")).alias("bits"), F.when(few, F.array_sort("places")).alias("places"))


def keys_in(index: DataFrame) -> DataFrame:
    """Number of keys of each index row."""
    return index.withColumn("n", F.when(F.col("places").isNotNull(), F.size("places").cast("bigint")).otherwise(F.bitmap_count("bits")))


def known_keys(index: DataFrame, wanted: DataFrame, key: str = "id_venta") -> DataFrame:
    """Keys of ``wanted`` that the index holds, each once.

    ``wanted`` is read a few times and should be a stored table. Of the index
    only buckets inside the range of ``wanted`` are read, and only those it
    has keys in are merged.
    """
    keys = wanted.select(F.col(key).cast("bigint").alias(key)).where(F.col(key).isNotNull()).distinct()
    keys = keys.select(key, _bucket(key), _place(key).alias("_place"))
    buckets = wanted.select(F.bitmap_bucket_number(F.col(key).cast("bigint")).alias("bucket")).where("bucket is not null")
    near = stored_keys_near(index, buckets, "bucket", ("bits", "places"))
    near = near.join(broadcast_if_small(buckets.distinct(), wanted), "bucket", "left_semi")
    merged = near.groupBy("bucket").agg(
        F.bitmap_or_agg(F.coalesce("bits", F.lit(b""))).alias("bits"),
        F.flatten(F.collect_list("places")).alias("places"))  # a bucket's keys: bounded
    byte = F.conv(F.hex(F.expr("substring(bits, _place div 8 + 1, 1)")), 16, 10).cast("int")
    bit = F.coalesce(F.getbit(byte, F.col("_place") % 8), F.lit(0)) == 1
    return keys.join(merged, "bucket").where(bit | F.array_contains("places", F.col("_place"))).select(key)
