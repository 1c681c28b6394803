"""Snapshots in hash buckets of a key: a write replaces the buckets it names, all others stay as they are.

A write puts its buckets into a folder of its own and then a new manifest,
which says for every bucket which folder holds it. The manifest appears by a
rename, so readers see all of a write or nothing of it; the manifests before
it, as many as are kept, still name what they named.

    b00000001/_bucket=0/..  b00000001/_bucket=1/..     first write
    b00000002/_bucket=1/..                             a batch that touched bucket 1
    _manifest/m00000002.json                           {"buckets": 2, "folders": {"0": "b00000001", "1": "b00000002"}}
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.session import shuffles_dropped

BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(buckets)).cast("int")


class BucketedSnapshot:
    """One table; ``buckets`` counts for its first write, afterwards its manifest says how many there are."""

    def __init__(self, store, name: str, key: str, buckets: int):
        self.store, self.root, self.key, self.first = store, store.path(name), key, buckets

    # -- manifests -------------------------------------------------------------

    def manifests(self) -> list[str]:
        return [m for m in self.store._children(f"{self.root}/_manifest") if m.startswith("m") and m.endswith(".json")]

    def manifest(self, back: int = 0) -> dict | None:
        names = self.manifests()
        return self._load(names[-1 - back]) if len(names) > back else None

    def _load(self, name: str) -> dict:
        return json.loads(self.store._read_text(f"{self.root}/_manifest/{name}"))

    @property
    def buckets(self) -> int:
        now = self.manifest()
        return now["buckets"] if now else self.first

    # -- rows ------------------------------------------------------------------

    def bucket(self, key: str | None = None) -> Column:
        return _bucket(key or self.key, self.buckets)

    def buckets_of(self, rows: DataFrame, key: str | None = None) -> list[int]:
        """Buckets in which the keys of ``rows`` lie: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket(key)).distinct().collect())

    def read(self, schema: str, buckets: list[int] | None = None, back: int = 0) -> DataFrame:
        """All rows, or those of some buckets: no file of another bucket is opened."""
        now = self.manifest(back)
        folders = {} if now is None else {int(b): f for b, f in now["folders"].items() if buckets is None or int(b) in set(buckets)}
        if not folders:
            return self.store.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{folder}/{BUCKET}={b}" for b, folder in sorted(folders.items())]
        return self.store.spark.read.schema(schema).parquet(*paths)

    def write(self, df: DataFrame, touched: list[int] | None = None, keep: int = 2) -> str:
        """Replace the buckets ``touched``, by default all, with the rows of ``df``; the newest ``keep`` manifests stay.

        ``df`` must hold all rows of the touched buckets and none of others.
        """
        now, buckets = self.manifest(), self.buckets
        partly = touched is not None and now is not None
        kept = {b: f for b, f in now["folders"].items() if int(b) not in set(touched)} if partly else {}
        return self._commit(df, buckets, set(touched) if partly else set(range(buckets)), kept, keep)

    def rebucket(self, schema: str, buckets: int) -> str:
        """Deal all rows into another number of buckets."""
        return self._commit(self.read(schema), buckets, set(range(buckets)), {}, 2)

    def _commit(self, df: DataFrame, buckets: int, touched: set[int], kept: dict[str, str], keep: int) -> str:
        names = self.manifests()
        number = int(names[-1][1:-5]) + 1 if names else 1
        folder = f"b{number:08d}"
        # one file a bucket; a folder of this number is what a write that was cut off has left
        rows = df.withColumn(BUCKET, _bucket(self.key, buckets)).repartition(max(1, len(touched)), BUCKET)
        with shuffles_dropped(df.sparkSession):
            rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        made = [c.split("=")[1] for c in self.store._children(f"{self.root}/{folder}") if c.startswith(f"{BUCKET}=")]
        if stray := {int(b) for b in made} - touched:
            raise ValueError(f"rows of buckets {sorted(stray)} in a write of others")
        self.store._write_text(f"{self.root}/_manifest/m{number:08d}.json", json.dumps(
            {"buckets": buckets, "folders": kept | dict.fromkeys(made, folder)}))
        self._forget(keep)
        return folder

    def _forget(self, keep: int) -> None:
        """Drop manifests but the newest ``keep``, and the buckets that only they named."""
        names = self.manifests()
        old, stay = names[:-keep], names[-keep:]
        named = lambda several: {(f, b) for m in several for b, f in self._load(m)["folders"].items()}
        gone = named(old) - named(stay)
        for folder, bucket in sorted(gone):
            self.store._drop(f"{self.root}/{folder}/{BUCKET}={bucket}")
        for folder in {f for f, _ in gone}:
            if not any(c.startswith(f"{BUCKET}=") for c in self.store._children(f"{self.root}/{folder}")):
                self.store._drop(f"{self.root}/{folder}")
        for name in old:
            self.store._drop(f"{self.root}/_manifest/{name}")
