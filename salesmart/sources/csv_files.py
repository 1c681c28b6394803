"""CSV ingest as all-string rows with lineage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.functions.normalize import missing_to_null
from salesmart.schemas import BUSINESS_COLUMNS, RAW_CSV

_ROW_BITS = (1 << 33) - 1


def read_csv(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Rows as text; tokens for missing values become null.

    ``row_seq`` is the place of a row in its file: the offset of the block
    it was read from plus its place in the task, which is always below the
    next block's offset because a row is longer than a byte.
    """
    return place_rows(file_columns(spark.read.csv(
        path, schema=RAW_CSV, header=True, multiLine=multiline, encoding="UTF-8", enforceSchema=False)))


def file_columns(rows: DataFrame) -> DataFrame:
    """Business columns with the file and block each row came from; batch or stream."""
    return rows.select(
        *[missing_to_null(F.col(c)).alias(c) for c in BUSINESS_COLUMNS],
        F.col("_metadata.file_name").alias("archivo_origen"),
        F.col("_metadata.file_block_start").alias("_block"))


def place_rows(rows: DataFrame) -> DataFrame:
    place = F.monotonically_increasing_id().bitwiseAND(_ROW_BITS)
    return rows.withColumn("row_seq", F.col("_block") + place).drop("_block")


def stamp_lineage(rows: DataFrame, batch_id: str, loaded_at: datetime) -> DataFrame:
    return rows.withColumns({"fecha_carga": F.lit(loaded_at).cast("timestamp"),
                             "id_batch": F.lit(batch_id)})


def read_after(source: DataFrame, column: str, loaded: DataFrame) -> DataFrame:
    """Rows of ``source`` beyond the highest loaded value (all rows when nothing is loaded).

    The mark is a scalar subquery, so the comparison reaches the file scan.
    """
    mark = loaded.agg(F.max(column)).scalar()
    return source.where(mark.isNull() | (F.col(column) > mark))
