"""Incremental ingest and running totals with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.operators import quality
from salesmart.operators.cleaning import stored_keys_near
from salesmart.session import materialise
from salesmart.plans.batch_load import Warehouse
from salesmart.schemas import RAW_CSV
from salesmart.sources.csv_files import file_columns, place_rows
from salesmart.sources.tables import Store


def file_stream(spark: SparkSession, folder: str, schema, pattern: str | None = None,
                files_per_trigger: int | None = None, kind: str = "parquet", **options) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def ingest(stream: DataFrame, store: Store, table: str, checkpoint: str,
           transform: Callable[[DataFrame, str], DataFrame] | None = None) -> None:
    """Drain the stream into a batch table, one folder per micro-batch.

    The folder is named after the micro-batch, so a replayed micro-batch
    replaces its own rows.
    """
    def write(rows: DataFrame, number: int) -> None:
        batch_id = f"s{number:08d}"
        rows = rows if transform is None else transform(rows, batch_id)
        store.overwrite_batch(table, rows, batch_id)

    _drain(stream.writeStream.foreachBatch(write), checkpoint)


def load_new_files(house: Warehouse, folder: str, checkpoint: str,
                   clock: Callable[[int], datetime], files_per_trigger: int | None = None,
                   **options) -> None:
    """Run the whole batch load on sales files that arrived since the last call.

    Each micro-batch is one batch named after it, so a replay after a crash
    repeats the same batch and changes nothing. ``clock`` gives the load time
    of a micro-batch number.
    """
    stream = file_columns(file_stream(house.spark, folder, RAW_CSV, kind="csv", header="true",
                                      files_per_trigger=files_per_trigger))

    def load(rows: DataFrame, number: int) -> None:
        house.run(place_rows(rows), "incremental", f"s{number:08d}", clock(number), **options)

    _drain(stream.writeStream.foreachBatch(load), checkpoint)


def new_only(existing: Callable[[], DataFrame], key: str) -> Callable[[DataFrame, str], DataFrame]:
    """Transform for ``ingest``: drop keys other micro-batches have stored."""
    def apply(rows: DataFrame, batch_id: str) -> DataFrame:
        stored = stored_keys_near(existing().where(F.col("id_batch") != batch_id), rows, key)
        wanted = stored.join(rows.select(key), key, "left_semi")
        return rows.join(wanted, key, "left_anti")
    return apply


def dedupe_late(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the allowed delay; state is bounded by it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def daily_totals(stream: DataFrame, ts: str, by: list[str], value: str, delay: str) -> DataFrame:
    """Sales per day and group with the last event seen; state of a day is kept until the watermark has passed it."""
    return (stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("filas"), F.sum(value).alias("total"), F.max(ts).alias("ultimo"))
            .select(F.to_date("w.start").alias("dia"), *by, "filas", "total", "ultimo"))


def daily_quality(stream: DataFrame, ts: str, delay: str, rules: list[quality.Rule] | None = None) -> DataFrame:
    """Rows of each day, and how many break each rule that looks at one row (``r0``, ``r1``, ...), as they arrive.

    The state is one row per open day. Rows that come late by up to ``delay``
    are counted in their day, later ones are not; null stamps are in no day.
    Rules that compare rows (repeated keys) are not among them.
    """
    rules = quality.load_rules() if rules is None else rules
    return (stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("registros_evaluados"), *quality.broken_counts(rules), F.max(ts).alias("ultimo"))
            .select(F.to_date("w.start").alias("dia"), F.date_format("w.start", "yyyy-MM").alias("mes"), "*").drop("w"))


def quality_by_day(totals: DataFrame, rules: list[quality.Rule] | None = None) -> DataFrame:
    """Per day and rule what the batch log says, with the day's mean of the rules as ``score``."""
    names = quality.rule_names(quality.load_rules() if rules is None else rules)
    n = F.col("registros_evaluados")
    ratios = sum(((n - F.col(f"r{i}")) / n for i in range(len(names))), F.lit(0.0))
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(names))
    long = totals.withColumn("score", F.round(ratios / len(names), 4)).selectExpr(
        "dia", "registros_evaluados", "score", f"stack({len(names)}, {pairs}) as (regla_calidad, registros_invalidos)")
    return long.withColumn("registros_validos", n - F.col("registros_invalidos"))


def write_updated(totals: DataFrame, keys: list[str], path: str, checkpoint: str, folder: str = "dia") -> None:
    """Drain totals into a table with a folder per ``folder``, replacing the rows of it and ``keys`` that changed.

    Open days are there from their first event on. A replayed micro-batch
    writes the same rows again.
    """
    spark = totals.sparkSession

    def replace(rows: DataFrame, number: int) -> None:
        rows = materialise(rows)
        if rows.isEmpty():
            return
        try:
            stored = spark.read.parquet(path)
        except AnalysisException:  # the first micro-batch
            stored = rows.limit(0)
        kept = (stored.join(rows.select(folder).distinct(), folder, "left_semi")
                .join(rows.select(folder, *keys), [folder, *keys], "left_anti"))
        after = materialise(kept.unionByName(rows))
        after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)

    _drain(totals.writeStream.outputMode("update").foreachBatch(replace), checkpoint)


def with_final(totals: DataFrame, delay: str) -> DataFrame:
    """Daily totals with ``final``: the watermark, ``delay`` behind the last event, has passed the day."""
    watermark = totals.agg(F.max("ultimo")).scalar() - F.expr(f"INTERVAL {delay}")
    return totals.withColumn("final", F.date_add("dia", 1).cast("timestamp") <= watermark).drop("ultimo")


def _drain(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
