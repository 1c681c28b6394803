"""Warehouse tables as Parquet folders.

Two kinds of tables, both without row updates:

* *batch tables* have one folder per ``id_batch``. A batch is replaced,
  appended to or dropped as a folder. What was measured while it was written
  (rows, extent of stamps and keys) stays in ``_batches`` as its manifest.
* *snapshot tables* have one folder per version. A version counts once its
  job has committed (``_SUCCESS``), so readers never see half a write, and
  the previous version stays readable. Those named in ``bucketed`` are kept
  in hash buckets of a key, of which a write replaces only some
  (``sources/buckets.py``).

One writer at a time is assumed.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from salesmart.session import shuffles_dropped
from salesmart.sources.buckets import BucketedSnapshot

# Days a row stays, and the column that says since when; tables not named here are kept for good.
RETENTION_DAYS = {
    "staging/ventas_llaves": ("fecha_procesamiento", 7),
    "control/rechazos": ("fecha_rechazo", 30),
    "staging/ventas_raw": ("fecha_carga", 7),
    "staging/ventas_clean": ("fecha_procesamiento", 30),
    "control/data_quality_log": ("fecha_validacion", 365),
    "control/etl_execution_log": ("fecha_inicio", 365),
}

# Columns whose least and greatest value a batch's manifest has; of timestamps as microseconds, of dates as days since 1970.
ZONES = {
    "staging/ventas_raw": ("fecha_carga",),
    "staging/ventas_clean": ("fecha_procesamiento", "id_venta"),
    "staging/ventas_llaves": ("fecha_procesamiento", "id_venta"),
    "control/rechazos": ("fecha_rechazo",),
    "control/data_quality_log": ("fecha_validacion",),
    "control/etl_execution_log": ("fecha_inicio",),
    "dwh/fact_ventas": ("fecha_carga", "fecha_venta", "id_venta"),
}

# Tables of a row a sale, the bulk of a warehouse. Others keep the session's codec: their size on disk says what a broadcast takes.
SALES = ("staging/ventas_raw", "staging/ventas_clean", "staging/ventas_llaves", "control/rechazos", "dwh/fact_ventas")


def _codec(name: str) -> dict[str, str]:
    return {"compression": "zstd"} if name in SALES else {}


def _zones(name: str, df: DataFrame) -> list[Column]:
    """Rows, and the extent of each zone column, as aggregates."""
    out, kinds = [F.count(F.lit(1)).alias("filas")], dict(df.dtypes)
    for c in ZONES.get(name, ()):
        as_number = {"timestamp": F.unix_micros, "date": F.unix_date}.get(kinds.get(c), lambda x: x)
        if c in kinds:
            out += [F.min(as_number(F.col(c))).alias(f"min_{c}"), F.max(as_number(F.col(c))).alias(f"max_{c}")]
    return out


class Store:
    """``bucketed`` names snapshot tables with their key and the number of buckets they start with."""

    def __init__(self, spark: SparkSession, root: str, bucketed: dict[str, tuple[str, int]] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.bucketed = {name: BucketedSnapshot(self, name, key, many) for name, (key, many) in (bucketed or {}).items()}

    # -- folders -------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _path(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, path: str) -> bool:
        fs, p = self._path(path)
        return fs.exists(p)

    def _children(self, path: str) -> list[str]:
        fs, p = self._path(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _drop(self, path: str) -> bool:
        fs, p = self._path(path)
        return fs.delete(p, True)

    def remove(self) -> None:
        """Delete all tables."""
        self._drop(self.root)

    def _read_text(self, path: str) -> str:
        fs, p = self._path(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        fs, part = self._path(f"{path}.part")
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        _, whole = self._path(path)
        fs.delete(whole, False)
        if not fs.rename(part, whole):
            raise OSError(f"cannot write {path}")

    # -- batch tables ----------------------------------------------------------

    def read(self, name: str, schema: str) -> DataFrame:
        """A batch table; empty when nothing was written yet."""
        if not self.batches(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def batches(self, name: str) -> list[str]:
        return [c.split("=", 1)[1] for c in self._children(self.path(name)) if c.startswith("id_batch=")]

    def read_batch(self, name: str, schema: str, batch_id: str) -> DataFrame:
        return self.read(name, schema).where(F.col("id_batch") == batch_id)

    def read_other(self, name: str, schema: str, batch_id: str) -> DataFrame:
        return self.read(name, schema).where(F.col("id_batch") != batch_id)

    def _folder(self, name: str, batch_id: str) -> str:
        if "/" in batch_id or "=" in batch_id:
            raise ValueError("batch ids must not contain / or =")
        return f"{self.path(name)}/id_batch={batch_id}"

    def overwrite_batch(self, name: str, df: DataFrame, batch_id: str, counts: dict[str, Column] | None = None) -> dict:
        """Replace one batch; the same batch written twice leaves one copy.

        Returns what was measured while writing, without another scan: the
        rows (``filas``), the extent of the table's zone columns, and
        ``counts``. It is kept as the batch's manifest.
        """
        rows, seen = df.drop("id_batch"), Observation()
        counts = {} if counts is None else counts
        folder = self._folder(name, batch_id)
        self._drop(self._manifest(name, batch_id))  # until the rows are there, nothing is known of them
        measured = rows.observe(seen, *_zones(name, rows), *[c.alias(n) for n, c in counts.items()])
        with shuffles_dropped(df.sparkSession):
            measured.write.mode("overwrite").options(**_codec(name)).parquet(folder)
        got = {"filas": 0, **dict.fromkeys(counts, 0)} | {k: v for k, v in seen.get.items()}
        self._write_text(self._manifest(name, batch_id), json.dumps(got, default=str))
        return got

    def append_batch(self, name: str, df: DataFrame, batch_id: str) -> None:
        self._drop(self._manifest(name, batch_id))
        with shuffles_dropped(df.sparkSession):
            df.drop("id_batch").write.mode("append").options(**_codec(name)).parquet(self._folder(name, batch_id))

    def drop_batch(self, name: str, batch_id: str) -> bool:
        self._drop(self._manifest(name, batch_id))
        return self._drop(self._folder(name, batch_id))

    def rewrite_batches(self, name: str, df: DataFrame, same_rows: bool = False) -> None:
        """Replace exactly the batches that occur in ``df`` with its rows; it may read them: they go when all is written.

        Manifests of the table go, unless the rows are ``same_rows``: as many
        as before, with the same stamps and keys.
        """
        if not same_rows:
            self._drop(f"{self.path(name)}/_batches")
        with shuffles_dropped(df.sparkSession):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**_codec(name))
             .partitionBy("id_batch").parquet(self.path(name)))

    def _manifest(self, name: str, batch_id: str) -> str:
        return f"{self.path(name)}/_batches/{batch_id}.json"

    def manifests(self, name: str, schema: str) -> dict[str, dict]:
        """What is known of each batch of a table: a small file each. Only a batch without one is read, once."""
        out, there = {}, set(self._children(f"{self.path(name)}/_batches"))
        for batch_id in self.batches(name):
            if f"{batch_id}.json" in there:
                out[batch_id] = json.loads(self._read_text(self._manifest(name, batch_id)))
                continue
            rows = self.read_batch(name, schema, batch_id)
            out[batch_id] = rows.agg(*_zones(name, rows)).first().asDict()
            self._write_text(self._manifest(name, batch_id), json.dumps(out[batch_id], default=str))
        return out

    def footprint(self, names: dict[str, tuple[str, str]]) -> DataFrame:
        """tabla, id_batch, registros, mas_antiguo and mas_reciente from the manifests of tables (name: schema, stamp)."""
        rows = [(name, batch_id, m["filas"], m.get(f"min_{stamp}"), m.get(f"max_{stamp}"))
                for name, (schema, stamp) in names.items() for batch_id, m in self.manifests(name, schema).items()]
        made = self.spark.createDataFrame(rows, "tabla string, id_batch string, registros bigint, lo bigint, hi bigint")
        return made.select("tabla", "id_batch", "registros", F.timestamp_micros("lo").alias("mas_antiguo"),
                           F.timestamp_micros("hi").alias("mas_reciente"))

    def expire(self, name: str, schema: str, stamp: str, days: int, now: datetime) -> int:
        """Drop rows older than ``days``; whole batches go as folders, by their manifests. Returns batches touched."""
        cutoff = now - timedelta(days=days)
        micros = round(cutoff.timestamp() * 1_000_000)
        known = {b: m for b, m in self.manifests(name, schema).items() if m.get(f"min_{stamp}") is not None}
        old = {b: m for b, m in known.items() if m[f"min_{stamp}"] < micros}
        for batch_id, m in old.items():
            if m[f"max_{stamp}"] < micros:
                self.drop_batch(name, batch_id)
        mixed = [b for b, m in old.items() if m[f"max_{stamp}"] >= micros]
        if mixed:
            rows = self.read(name, schema).where(F.col("id_batch").isin(mixed) & (F.col(stamp) >= F.lit(cutoff)))
            for batch_id in mixed:
                self._drop(self._manifest(name, batch_id))
            self.rewrite_batches(name, rows, same_rows=True)
        return len(old)

    # -- snapshot tables -------------------------------------------------------

    def versions(self, name: str) -> list[str]:
        return [v for v in self._children(self.path(name))
                if v.startswith("v") and self._exists(f"{self.path(name)}/{v}/_SUCCESS")]

    def read_snapshot(self, name: str, schema: str, back: int = 0, buckets: list[int] | None = None) -> DataFrame:
        """The newest committed version, or an earlier one; of a bucketed table all buckets or some."""
        table = self.bucketed.get(name)
        if table is not None and table.manifests():
            return table.read(schema, buckets, back)
        versions = self.versions(name)
        if len(versions) <= back:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path(name)}/{versions[-1 - back]}")
        return rows if buckets is None else rows.where(table.bucket().isin(buckets))

    def buckets_of(self, name: str, rows: DataFrame, key: str | None = None) -> list[int]:
        """Buckets of a bucketed table that hold, or would hold, the keys of ``rows``."""
        return self.bucketed[name].buckets_of(rows, key)

    def write_buckets(self, name: str, df: DataFrame, touched: list[int], keep: int = 2) -> str | None:
        """Replace some buckets of a bucketed table; writes nothing for none."""
        table = self.bucketed[name]
        if not touched and table.manifests():
            table._forget(keep)
            return None
        if not table.manifests() and self.versions(name):  # a table from before it had buckets
            raise ValueError(f"{name} has no buckets yet: write_snapshot it once")
        return table.write(df, touched, keep)

    def write_snapshot(self, name: str, df: DataFrame, keep: int = 2) -> str:
        """Write a new version; of the versions then there, the newest ``keep`` stay."""
        if name in self.bucketed:
            plain = self.versions(name)
            folder = self.bucketed[name].write(df, None, keep)
            for old in plain:
                self._drop(f"{self.path(name)}/{old}")
            return folder
        versions = self.versions(name)
        version = f"v{(int(versions[-1][1:]) if versions else 0) + 1:08d}"
        with shuffles_dropped(df.sparkSession):
            df.write.mode("overwrite").parquet(f"{self.path(name)}/{version}")
        for old in versions[:max(0, len(versions) + 1 - keep)]:
            self._drop(f"{self.path(name)}/{old}")
        return version
