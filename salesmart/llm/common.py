"""What the operators share: readers, Arrow scans, scratch tables, column hygiene."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from salesmart.session import scratch_path

# Rows handed to a Python worker at once; long texts make a row large.
ARROW_ROWS = 512
ARROW_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# ASCII whitespace: what splits words in every contract of this package.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(schema: StructType | str) -> pa.Schema:
    """The Arrow form of a Spark schema; made on the driver, carried to tasks."""
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def scan(df: DataFrame, work: Callable[[dict[str, list]], dict[str, list]], schema: StructType | str) -> DataFrame:
    """Apply ``work`` to Arrow batches of ``df`` as columns of Python values.

    ``work`` maps a dict of columns to a dict of columns of any equal length.
    Batches are bounded by ``ARROW_ROWS``; nothing is kept between batches.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    arrow = arrow_schema(schema)
    names = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = work({name: batch.column(i).to_pylist() for i, name in enumerate(names)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python workers so many rows at once for what is run inside; the session's own setting comes back after."""
    before = spark.conf.get(ARROW_SETTING, None)
    spark.conf.set(ARROW_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_SETTING) if before is None else spark.conf.set(ARROW_SETTING, before)


def word_count(text: str = "text"):
    """Number of words of a text, null as none, without splitting it into an array of strings.

    A word starts where a non-blank follows a blank or the start: count the blanks that a
    non-blank follows, after a blank is put before the text.
    """
    padded = F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")))
    return F.regexp_count(padded, F.lit(f"[{SPACE_CLASS}][^{SPACE_CLASS}]")).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, one for each of ``names``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Return what a Python worker has freed to the system; a reused worker would keep it while Spark needs it elsewhere."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Scratch:
    """Tables below the shared folder: each is written once and read by later steps.

    A written table cuts lineage: when an executor is lost, later steps read
    it again instead of repeating what led to it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, name)
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def keep(self, df: DataFrame, name: str, by: str | None = None, **options) -> DataFrame:
        """Write ``df``, in folders of the column ``by`` if given, and read it back."""
        path, before = self.path(name), self.spark.conf.get(SHUFFLE_CLEANUP, None)
        if before is not None:  # what was shuffled for the table isn't needed once it is written
            self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            writer = df.write.options(**options)
            (writer.partitionBy(by) if by else writer).parquet(path)
        finally:
            if before is not None:
                self.spark.conf.set(SHUFFLE_CLEANUP, before)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        """Delete a table that no later step reads."""
        self.drop_path(kept.scratch_path)

    def drop_path(self, path: str) -> None:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
