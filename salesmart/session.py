"""Session settings, size checks and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # methods above this many bytecodes are never JIT-compiled by the JVM; wide
    # cleaning projections then run faster without whole-stage code
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A table below this size on disk may be broadcast or windowed in one task.
SMALL_BYTES = 32 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "salesmart", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(
        # checkpoints hold customer rows: they go when nothing refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``; reads statistics only, runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """True when the estimated size of ``df`` is within ``limit`` (default ``SMALL_BYTES``)."""
    try:
        return plan_bytes(df) <= (SMALL_BYTES if limit is None else limit)
    except AttributeError:  # no JVM plan at hand (Spark Connect): assume large
        return False


def broadcast_if_small(df: DataFrame, bound: DataFrame | None = None,
                       limit: int | None = None) -> DataFrame:
    """Hint a broadcast only when ``bound`` (default ``df``) is proven small.

    ``bound`` is a table that ``df`` cannot outgrow, such as the base table
    of a dimension that was only widened by many-to-one joins. Beyond the
    limit the frame is returned as it is and Spark shuffles both sides.
    """
    return F.broadcast(df) if is_small(df if bound is None else bound, limit) else df


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for checkpoints and scratch tables."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir() + "/salesmart-checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a table that is written inside goes once the table is there, not when the driver collects garbage."""
    if not spark.conf.isModifiable(SHUFFLE_CLEANUP):  # an older Spark
        yield
        return
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class JobScratch:
    """Tables that a job writes for its own later steps, in one folder below the shared one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, name)
        self._count = 0

    def keep(self, df: DataFrame, **options) -> DataFrame:
        """Write ``df`` and read it back."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}"
        with shuffles_dropped(df.sparkSession):
            df.write.options(**options).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        """Delete a table that no later step reads."""
        self._delete(kept.scratch_path)

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_JOB: contextvars.ContextVar[JobScratch | None] = contextvars.ContextVar("job", default=None)


@contextlib.contextmanager
def scratch_of_job(spark: SparkSession, name: str) -> Iterator[JobScratch]:
    """What is materialised inside are tables of one folder, which goes at the end.

    For jobs that write their results: a DataFrame that leaves the job must
    not read a scratch table.
    """
    scratch = JobScratch(spark, name)
    token = _JOB.set(scratch)
    try:
        yield scratch
    finally:
        _JOB.reset(token)
        scratch.close()


def materialise(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where row placement is sampled (range sorts) and two later steps
    must see the same placement, also after an executor is lost. Inside
    ``scratch_of_job`` it is a Parquet table, written with ``options``, that
    goes with the job; otherwise a checkpoint.
    """
    job = _JOB.get()
    if job is not None:
        return job.keep(df, **options)
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
