"""Exact ranks, row numbers, tiles and percentiles over tables of any size.

A window without ``partitionBy`` sorts everything in one task. That is fine
for a table whose size is checked and small. For larger ones rows are
range-sorted, summed up within their range, and offset by the sums of the
ranges before it; equal values are counted before they are shuffled, so a
frequent value is one row. Both ways take any type that Spark can order, put
nulls last and keep every row, also those whose value or group is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.session import is_small, materialise


def _as_long(df: DataFrame, name: str) -> Column:
    """A decimal column as a bigint in the same order."""
    scale = int(dict(df.dtypes)[name].rstrip(")").split(",")[1])
    return (F.col(name) * F.lit(10 ** scale).cast("decimal(19,0)")).cast("bigint")


def _order(name: str, descending: bool) -> Column:
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` in which nulls are equal; the keys come from the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, condition).drop(*[f"_right_{k}" for k in keys])


def running_before(rows: DataFrame, order: list[Column], weight: str, out: str,
                   by: list[str] | None = None) -> DataFrame:
    """Sum of ``weight`` over all rows of the same ``by`` that come before each in ``order``.

    ``order`` must be unique within ``by``. Placement in a range sort is
    sampled, so the placed rows are written once.
    """
    by = by or []
    full = [*[F.col(k).asc_nulls_last() for k in by], *order]
    placed = materialise(rows.repartitionByRange(*full).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*full).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: as many as there are shuffle partitions
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.sum(weight).alias("_w"))
               .select("_part", F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_offset")))
    summed = placed.withColumn(out, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    summed = summed.join(F.broadcast(offsets), "_part").withColumn(out, F.col(out) + F.col("_offset")).drop("_part", "_offset")
    if not by:
        return summed
    starts = summed.groupBy(*by).agg(F.min(out).alias("_start"))
    return join_null_safe(summed, starts, by).withColumn(out, F.col(out) - F.col("_start")).drop("_start")


def with_rank(df: DataFrame, value: str, out: str, *, by: list[str] | None = None,
              method: str = "rank", descending: bool = True,
              bound: DataFrame | None = None) -> DataFrame:
    """Add ``rank`` or ``dense_rank`` of ``value``, nulls last; ``bound`` caps the row count.

    ``bound`` is a table (a dimension) that ``df`` cannot outgrow; when its
    size is checked and small one window does the job.
    """
    by = by or []
    if bound is not None and is_small(bound):
        function = F.rank() if method == "rank" else F.dense_rank()
        return df.withColumn(out, function.over(
            Window.partitionBy(*by).orderBy(_order(value, descending))).cast("bigint"))
    # read twice below: written once, so the plan above runs once
    kept = materialise(df)
    counts = kept.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    if method != "rank":
        counts = counts.withColumn("_n", F.lit(1).cast("bigint"))
    ranks = (running_before(counts, [_order(value, descending)], "_n", "_before", by)
             .select(*by, value, (F.col("_before") + 1).alias(out)))
    # one row per value on the right, so tied rows on the left may be split
    return join_null_safe(kept, ranks, [*by, value])


def with_row_number(df: DataFrame, value: str, key: str, out: str, *,
                    descending: bool = True, bound: DataFrame | None = None) -> DataFrame:
    """Position by ``value``, ties by the unique ``key`` ascending; nulls last in both."""
    order = [_order(value, descending), _order(key, False)]
    if bound is not None and is_small(bound):
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    placed = running_before(df.withColumn("_n", F.lit(1).cast("bigint")), order, "_n", out)
    return placed.withColumn(out, F.col(out) + 1).drop("_n")


def with_ntile(df: DataFrame, tiles: int, value: str, key: str, out: str, *,
               bound: DataFrame | None = None) -> DataFrame:
    """``NTILE(tiles)`` by descending ``value``, nulls last; the first tiles get the remainder."""
    if bound is not None and is_small(bound):
        return df.withColumn(out, F.ntile(tiles).over(
            Window.orderBy(_order(value, True), _order(key, False))).cast("bigint"))
    placed = materialise(with_row_number(df, value, key, "_pos"))
    total = placed.agg(F.count(F.lit(1))).scalar()
    size = F.floor(total / tiles)
    longer = total % tiles
    head = longer * (size + 1)
    position = F.col("_pos") - 1
    tile = F.when(position < head, F.floor(F.try_divide(position, size + 1))).otherwise(
        longer + F.floor(F.try_divide(position - head, size)))
    return placed.withColumn(out, (tile + 1).cast("bigint")).drop("_pos")


def exact_percentiles(values: DataFrame, group: str, value: str,
                      probabilities: dict[str, float], weight: str | None = None) -> DataFrame:
    """Linear-interpolated percentiles of a decimal ``value`` per ``group``; a row counts ``weight`` times.

    One row per group with a column per entry of ``probabilities`` and ``n``.
    Works from value counts, so no task ever holds a whole column.
    """
    scale = int(dict(values.dtypes)[value].rstrip(")").split(",")[1])
    counts = (values.where(F.col(value).isNotNull()).withColumn("_v", _as_long(values, value))
              .groupBy(group, "_v").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n")))
    placed = running_before(counts, [F.col("_v").asc()], "_n", "_before", [group])
    # a row per group, and groups are the profiled columns: bounded by the schema
    totals = placed.groupBy(group).agg(F.max(F.col("_before") + F.col("_n")).alias("n"))
    placed = join_null_safe(placed, F.broadcast(totals), [group])
    last = F.col("n") - 1

    def at(position: Column) -> Column:
        """The value that covers a 0-based position of the sorted column."""
        inside = (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))
        return F.max(F.when(inside, F.col("_v"))).cast("double")

    picks = []
    for name, p in probabilities.items():
        picks += [at(F.floor(last * F.lit(p))).alias(f"{name}_lo"),
                  at(F.ceil(last * F.lit(p))).alias(f"{name}_hi")]
    found = placed.groupBy(group).agg(F.first("n").alias("n"), *picks)
    out = []
    for name, p in probabilities.items():
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        fraction = (F.col("n") - 1) * F.lit(p) - F.floor((F.col("n") - 1) * F.lit(p))
        out.append(((low + (high - low) * fraction) / float(10 ** scale)).alias(name))
    return found.select(group, "n", *out)


def assign_keys(new: DataFrame, order_by: list[str], out: str,
                start: Column | int = 0, bound: DataFrame | None = None) -> DataFrame:
    """Consecutive surrogate keys ``start + 1 ..`` in the order of ``order_by``.

    ``order_by`` must be unique. Large inputs are range-sorted, each row
    keeps its place inside its range, and the ranges are offset by the sizes
    of the ranges before them. The placed rows are written once, because the
    cut points of a range sort are sampled.
    """
    start = F.lit(start) if isinstance(start, int) else start
    start = F.coalesce(start.cast("bigint"), F.lit(0).cast("bigint"))
    if bound is not None and is_small(bound):
        position = F.row_number().over(Window.orderBy(*order_by)).cast("bigint")
        return new.withColumn(out, start + position)
    placed = materialise(
        new.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()), compression="zstd")
    part = F.shiftright("_place", 33)
    row = F.col("_place").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("_part", part).withColumn("_row", row)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: as many as there are shuffle partitions
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(out, start + F.col("_offset") + F.col("_row") + 1)
            .drop("_part", "_row", "_place", "_offset"))
