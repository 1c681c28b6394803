"""Running sums within keys that may hold most of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.llm.common import Scratch

# Rows that a bucket aims at, and bits by which a level of buckets refines the one above.
BUCKET_ROWS, LEVEL_BITS = 512, 12


def with_running(rows: DataFrame, key: str, order: str, ties: list[str], values: dict[str, Column],
                 count: int, scratch: Scratch) -> DataFrame:
    """``rows`` with one column for each of ``values``: its sum over the earlier rows of the same key.

    Rows are ordered by ``order``, a hash spread over all 64 bits, then by
    ``ties``. The hash's leading bits cut a key into buckets of about
    ``BUCKET_ROWS`` of ``count`` rows; sums per bucket run level by level, so
    no window holds more than ``2 ** LEVEL_BITS`` buckets or one bucket's rows.
    """
    bits = max(1, math.ceil(math.log2(max(2, count / BUCKET_ROWS))))
    levels = [*range(LEVEL_BITS, bits, LEVEL_BITS), bits]
    bucket = lambda n: F.shiftright(order, 64 - n)
    finest = scratch.keep(rows.groupBy(F.col(key).alias("_k"), bucket(bits).alias("_b"))
                          .agg(*[F.sum(v).alias(f"_s_{name}") for name, v in values.items()]), "bucket-sums")
    before = None
    for level in levels:
        parent = levels[levels.index(level) - 1] if level != levels[0] else 0
        own = finest.groupBy("_k", F.shiftright("_b", bits - level).alias("_b")).agg(
            *[F.sum(f"_s_{name}").alias(f"_s_{name}") for name in values])
        up = F.shiftright("_b", level - parent) if parent else F.lit(0)
        own = own.withColumn("_up", up)
        within = Window.partitionBy("_k", "_up").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        own = own.select("_k", "_up", "_b", *[F.coalesce(F.sum(f"_s_{name}").over(within), F.lit(0)).alias(f"_o_{name}")
                                              for name in values])
        if before is not None:
            above = before.select(F.col("_k").alias("_pk"), F.col("_b").alias("_pb"),
                                  *[F.col(f"_o_{name}").alias(f"_p_{name}") for name in values])
            own = own.join(above, (F.col("_k") == F.col("_pk")) & (F.col("_up") == F.col("_pb")))
            own = own.select("_k", "_b", *[(F.col(f"_o_{name}") + F.col(f"_p_{name}")).alias(f"_o_{name}")
                                           for name in values])
        before = own.drop("_up")
    joined = rows.withColumn("_b2", bucket(bits)).join(
        before, (F.col(key) == F.col("_k")) & (F.col("_b2") == F.col("_b")))
    inside = (Window.partitionBy(key, "_b2").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1))
    return joined.select(*rows.columns, *[(F.col(f"_o_{name}") + F.coalesce(F.sum(v).over(inside), F.lit(0)))
                                          .cast("long").alias(name) for name, v in values.items()])
