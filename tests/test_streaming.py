"""Streams drained to completion, replayed and deduplicated."""

from datetime import datetime

from pyspark.sql import functions as F

from salesmart.plans.batch_load import Warehouse
from salesmart.sources.csv_files import read_after
from salesmart.sources.tables import Store
from salesmart.streaming.ingest import (daily_totals, dedupe_late, file_stream, ingest, load_new_files,
                                        new_only, with_final, write_updated)
from tests.sample_sales import INCREMENTAL, INITIAL, write_csv

SCHEMA = "k bigint, ts timestamp, v double"
STORED = "k bigint, ts timestamp, v double, id_batch string"


def _write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_ingest_new_files_once(spark, tmp_path):
    folder, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "out"))
    stored = lambda: store.read("t", STORED)
    _write(spark, folder, [(1, datetime(2024, 1, 1), 1.0), (1, datetime(2024, 1, 1, 0, 5), 1.0), (2, datetime(2024, 1, 1), 2.0)])

    def drain(checkpoint):
        stream = dedupe_late(file_stream(spark, folder, SCHEMA), "k", "ts", "1 hour")
        ingest(stream, store, "t", str(tmp_path / checkpoint), new_only(stored, "k"))

    drain("c1")
    _write(spark, folder, [(2, datetime(2024, 1, 2), 9.0), (3, datetime(2024, 1, 2), 3.0)])
    drain("c1")
    drain("c1")
    assert sorted(r.k for r in stored().collect()) == [1, 2, 3]
    # a lost checkpoint replays everything into the same folders
    drain("c2")
    assert sorted(r.k for r in stored().collect()) == [1, 2, 3]


def test_daily_totals_hold_open_days(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def drain():
        stream = daily_totals(file_stream(spark, folder, SCHEMA), "ts", [], "v", "1 hour")
        write_updated(stream, [], out, str(tmp_path / "c"))
        rows = with_final(spark.read.parquet(out), "1 hour").orderBy("dia").collect()
        return [(str(r.dia), r.filas, r.total, r.final) for r in rows]

    _write(spark, folder, [(d * 10 + h, datetime(2024, 1, d, h), 1.0) for d in (1, 2, 3) for h in (1, 2)])
    first = [("2024-01-01", 2, 2.0, True), ("2024-01-02", 2, 2.0, True), ("2024-01-03", 2, 2.0, False)]
    assert drain() == first
    assert drain() == first
    _write(spark, folder, [(90, datetime(2024, 1, 3, 5), 4.0), (91, datetime(2024, 1, 4, 5), 1.0)])
    assert drain() == [*first[:2], ("2024-01-03", 3, 6.0, True), ("2024-01-04", 1, 1.0, False)]


def test_watermark_reaches_the_scan(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(spark, folder, [(i, datetime(2024, 1, i), 1.0) for i in range(1, 6)])
    source = spark.read.parquet(folder)
    fresh = read_after(source, "ts", source.where(F.col("k") <= 3))
    assert sorted(r.k for r in fresh.collect()) == [4, 5]
    assert read_after(source, "ts", source.where("k > 99")).count() == 5


def test_files_load_as_batches(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.seed()
    landing = tmp_path / "landing"
    landing.mkdir()
    clock = lambda number: datetime(2026, 3, 11 + number)
    for name, rows in (("ventas_raw.csv", INITIAL), ("ventas_nuevas.csv", INCREMENTAL)):
        write_csv(landing, name, rows)
        load_new_files(house, str(landing), str(tmp_path / "c"), clock)
    load_new_files(house, str(landing), str(tmp_path / "c"), clock)
    totals = house.fact().groupBy("id_batch").agg(F.count(F.lit(1)), F.sum("monto_total")).orderBy("id_batch").collect()
    assert [(r[0], r[1], int(r[2])) for r in totals] == [("s00000000", 17, 1291000), ("s00000001", 7, 510000)]
