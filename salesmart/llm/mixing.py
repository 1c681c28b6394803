"""Mixing sources to target weights along a curriculum.

Each source has a demand of words and a schedule: its rate over training time
``t`` from 0 to 1. The integral of the schedule, inverted at a document's
place in its source's word stream, is the time at which the document is due;
documents sorted by it form the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.llm.common import Scratch, fresh, word_count
from salesmart.llm.running import with_running

# The weights that sources take in turn, and how often a source's words may repeat.
WEIGHT_CYCLE, MOST_EPOCHS = 3, 3
# Schedule: rate 1 + slope * (2 t - 1), with slope (weight - 2) * SLOPE; light sources fade, heavy ones grow.
SLOPE = 0.4
# Entries of one repeated row that are listed together.
REPEATS_AT_ONCE = 1 << 16


def stream_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Order of a source's documents: a hash of id and text, the same on every run and in other engines."""
    said = F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    digest = F.conv(F.substring(F.md5(said), 1, 16), 16, -10)
    return digest.cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, rank, weight, slope, source_size and target of each source of ``sizes(source, size)``.

    Targets share the sum of all sizes by weight. A source above
    ``MOST_EPOCHS`` times its size stops there and the rest is shared anew: in
    the order of room per weight, the level at which the sources from one on
    share what earlier ones leave rises until it is the final one, then falls,
    so the greatest is the final one. One row per source; windows run over those.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.col("rank") % WEIGHT_CYCLE + 1)
    ranked = ranked.withColumn("room", (F.col("source_size") * MOST_EPOCHS).cast("double"))
    all_rows = Window.partitionBy(F.lit(0))
    earlier = all_rows.orderBy(F.col("room") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum(F.col("source_size").cast("double")).over(all_rows) - F.coalesce(F.sum("room").over(earlier), F.lit(0.0))
    heavy = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    levels = ranked.withColumn("level", left / heavy)
    levels = levels.withColumn("level", F.max("level").over(all_rows))
    return levels.select("source", "rank", "weight", ((F.col("weight") - 2) * SLOPE).alias("slope"), "source_size",
                         F.least("room", F.col("level") * F.col("weight")).alias("target"))


def due_time(share: Column, slope: Column) -> Column:
    """Inverse of the integrated schedule t + slope * (t * t - t) at ``share``."""
    return 2.0 * share / ((1.0 - slope) + F.sqrt((1.0 - slope) * (1.0 - slope) + 4.0 * slope * share))


def plan(docs: DataFrame) -> DataFrame:
    """What the mix takes of every row of ``docs`` and when.

    doc_id, source, h (see ``stream_hash``), repeats and number (how many rows
    are equal in the three and in text, and which of them this is), size
    (words), source_size, target, taken (words, over up to three epochs; a
    source's sum is its target rounded, the last document of it may be taken
    in part), copies (epochs in which at least half of the document is taken),
    position (training time of its first word, null when nothing is taken),
    position_2 and position_3 (training time of the copies of the second and
    third epoch, null without one), place (position, or a number above 1 in
    stream order) and places (the training time of each copy, in its own
    epoch). Null texts have no words; a null source is a source; a source
    without words has no target; repeated rows are interchangeable and are
    counted before they are placed; an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    narrow = docs.select("doc_id", "source", word_count().alias("size"), stream_hash().alias("h"))
    sized = scratch.keep(narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("repeats")), "sizes")
    words = F.col("size") * F.col("repeats")
    sources = scratch.keep(source_targets(sized.select("source", words.alias("size"))).withColumnRenamed("source", "of"), "sources")
    rows = sized.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = with_running(rows, "rank", "h", ["doc_id", "size"], {"start": words}, sized.count(), scratch)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1, F.lit(REPEATS_AT_ONCE))).alias("_from"))
    last = F.least(F.col("_from") + REPEATS_AT_ONCE, "repeats") - 1
    rows = rows.select("*", F.explode(F.sequence("_from", last)).alias("number"))
    rows = rows.withColumn("start", F.col("start") + F.col("size") * F.col("number"))
    demand = F.round("target").cast("long")
    nth = lambda epoch: F.least(F.greatest(
        demand - (F.col("source_size") * epoch + F.col("start")), F.lit(0)), "size")
    epochs = [nth(e) for e in range(MOST_EPOCHS)]
    due = lambda epoch: F.when(F.col("target") > 0, due_time(
        (F.col("source_size") * epoch + F.col("start")) / F.col("target"), F.col("slope")))
    position = F.when(epochs[0] > 0, due(0))
    copied = [(e * 2 >= F.col("size")) & (e > 0) for e in epochs]
    late = 1.0 + (F.col("start") + 1) / (F.col("source_size") + 1)
    return rows.select(
        "doc_id", "source", "h", "repeats", "number", "size", "source_size", "target",
        sum(epochs[1:], epochs[0]).cast("long").alias("taken"),
        sum((F.when(c, 1).otherwise(0) for c in copied), F.lit(0)).alias("copies"),
        position.alias("position"), *[F.when(copied[e], due(e)).alias(f"position_{e + 1}") for e in range(1, MOST_EPOCHS)],
        F.coalesce(position, late).alias("place"),
        F.array_compact(F.array(*[F.when(c, due(e)) for e, c in enumerate(copied)])).alias("places"))


def scheduled_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them, range-sorted by position.

    A row comes as often as epochs take at least half of it, each time where
    its source's word stream has come round to it. Columns stay as they were.
    Rows equal in doc_id, source and text are numbered, by running counts that
    no single task holds, and the plan's entries are dealt to them by number;
    null texts and texts without words are never taken; an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "copies")
    key, of, source, place, places, number, again, order = fresh(
        docs, "_h", "_of", "_source", "_place", "_places", "_number", "_again", "_order")
    due = scratch.keep(plan(docs).select("source", "h", "repeats", "number", "copies", "places"), "due")
    due = due.select(F.col("source").alias(source), F.col("h").alias(of), "repeats", F.col("number").alias(number),
                     "copies", F.col("places").alias(places))
    keyed = docs.withColumn(key, stream_hash())
    same = lambda rows, other: (rows[key] == other[of]) & rows["source"].eqNullSafe(other[source])
    once = due.where("repeats = 1 and copies > 0").select(of, source, places)
    taken = keyed.join(once, same(keyed, once)).select(*docs.columns, F.explode(places).alias(place))
    several = due.where(f"repeats > 1 and {number} = 0").select(of, source)
    if not several.isEmpty():
        repeated = keyed.join(several, same(keyed, several), "left_semi").withColumn(again, F.monotonically_increasing_id())
        repeated = scratch.keep(repeated, "repeated")  # written, so that a row's number stays
        name = F.concat(F.col(key).cast("string"), F.coalesce(F.concat(F.lit("|"), "source"), F.lit("")))
        numbered = with_running(repeated.select(name.alias(order), F.xxhash64(again).alias(key), F.col(again).alias(of)),
                                order, key, [of], {number: F.lit(1)}, repeated.count(), scratch)
        numbered = numbered.select(F.col(of).alias(again), F.col(number))
        repeated = repeated.join(numbered, again)
        entries = due.where("repeats > 1 and copies > 0").select(of, source, number, places)
        repeated = repeated.join(entries, same(repeated, entries) & (repeated[number] == entries[number]))
        taken = taken.union(repeated.select(*docs.columns, F.explode(places).alias(place)))
    return taken.orderBy(place, "doc_id").select(*docs.columns)
