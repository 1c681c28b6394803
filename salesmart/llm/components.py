"""Connected components of links, with no node's links gathered in one place."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from salesmart.llm.common import Scratch


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the members ``a[i]``, ``b[i]`` in ``label``, where each member holds its root, the least of its set."""
    while True:
        left, right = label[a], label[b]
        apart = left != right
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(left, right)[apart], np.minimum(left, right)[apart])
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node that has a link in ``edges(a, b)``; component is the least node reached.

    Alternates two star steps until nothing changes, about as many times as
    the logarithm of the longest path. Both are a minimum per node, partly
    aggregated before the shuffle, and a join back that Spark splits where a
    node has many links. Repeated links and self links have no effect.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = scratch.keep(links, "links")
    before, now = None, _state(links)
    while now != before:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        large = (both.join(least.select("u", F.least("u", "least").alias("m")), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v"), F.col("m"))
        small = (small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        after = scratch.keep(small, "links")
        scratch.drop(links)
        links, before, now = after, now, _state(after)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
