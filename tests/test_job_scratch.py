"""What the jobs leave on disk: no scratch tables, no shuffle files, no second copy of files that don't change."""

import os
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.queries import _copy_of, _written
from salesmart import session
from salesmart.operators import cleaning
from salesmart.plans import batch_load
from salesmart.plans.batch_load import FACT_T, Warehouse
from salesmart.sources.tables import Store
from tests.test_batch_steps import loaded
from tests.test_rollback import sales


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    return loaded(spark, tmp_path_factory.mktemp("scratch"))


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_a_load_takes_its_scratch_tables_with_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    made = []
    keep = session.JobScratch.keep
    monkeypatch.setattr(session.JobScratch, "keep", lambda self, df, **o: (made.append(self.root), keep(self, df, **o))[1])
    kept = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    before = {p.name for p in kept.glob("rdd-*")}
    house = Warehouse(spark, str(tmp_path / "house"))
    house.run(sales(spark, (1, 7, "Cali", "siete@uno.co")), "incremental", "b1", datetime(2026, 3, 1))
    assert house.fact().count() == 1
    assert len(made) > 4 and not list((tmp_path / "shared").glob("*"))
    assert {p.name for p in kept.glob("rdd-*")} == before
    try:  # also one that fails
        house.run(sales(spark, (4, 9, "Cali", "x")), "incremental", "b3", datetime(2026, 3, 3), threshold=2)
    except ValueError:
        pass
    assert not list((tmp_path / "shared").glob("*"))
    assert session._JOB.get() is None


def test_what_a_write_shuffles_goes_with_the_write(spark, tmp_path):
    store, before = Store(spark, str(tmp_path / "store")), shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 as k", "id").repartition(3, "k")
    store.overwrite_batch("t", rows, "a")
    store.append_batch("t", rows, "a")
    store.rewrite_batches("t", rows.withColumn("id_batch", F.lit("c")))
    store.write_snapshot("s", rows)
    assert not shuffle_files(spark) - before
    rows.count()  # without a table the files stay until they are collected
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_copies_share_files_and_stay_apart(spark, house):
    before = sorted(map(tuple, house.raw().collect()), key=str)
    copy = _copy_of(house)
    files = [p for p in Path(copy.store.root.removeprefix("file:")).rglob("*.parquet") if p.is_file()]
    assert files and all(os.stat(p).st_nlink > 1 for p in files)
    copy.erase_customers(spark.createDataFrame([(7,), (9,)], "id_cliente bigint"), "dpo", datetime(2026, 3, 5))
    copy.rollback("b2", datetime(2026, 3, 6))
    assert sorted(map(tuple, house.raw().collect()), key=str) == before
    assert house.store.batches(FACT_T) == ["b1", "b2"] and copy.store.batches(FACT_T) == ["b1"]
    rows = _written(copy, copy.fact().groupBy("id_batch").count())
    assert not Path(copy.store.root.removeprefix("file:")).exists() and rows.collect()[0]["count"] == 2
    assert sorted(map(tuple, house.raw().collect()), key=str) == before


def test_erasure_writes_its_rows_once(spark, house, monkeypatch):
    house = _copy_of(house)
    monkeypatch.setattr(batch_load, "scratch_path", None)
    house.erase_customers(spark.createDataFrame([(7,)], "id_cliente bigint"), "dpo", datetime(2026, 3, 5))
    told = {r.id_cliente.strip(): r.email_cliente for r in house.raw().collect()}
    assert told["7"].endswith("@anonimo.test") and told["8"] == "ocho@uno.co" and house.clean().count() == 3


def test_stored_keys_that_are_few_move_no_row(spark, house, monkeypatch):
    house, plans = _copy_of(house), []
    monkeypatch.setattr(batch_load, "is_small", lambda *_: False)
    assign = batch_load.assign_keys
    monkeypatch.setattr(batch_load, "assign_keys", lambda new, *a, **o: (plans.append(
        new._jdf.queryExecution().executedPlan().toString()), assign(new, *a, **o))[1])
    house.run(sales(spark, (4, 9, "Cali", "x@uno.co"), (1, 7, "Cali", "y@uno.co")), "incremental", "b3", datetime(2026, 3, 3), threshold=0.5)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0] and "nombre" not in plans[0] and "canal#" not in plans[0]
    assert sorted(r.id_venta for r in house.fact().collect()) == [1, 2, 3, 4]


def test_rejected_rows_keep_the_text_of_their_id(spark):
    rows = [(" 1", "2024-01-05"), ("2", "2024-01-05"), ("3.0", "2024-01-05"), ("4", "x"), (None, "2024-01-05"), ("5", "2024-01-05")]
    raw = spark.createDataFrame([(i, d, "7", "8", "1", "9", "Online", "Cali", "v", "e", "t", datetime(2026, 3, 1), "f", n)
                                 for n, (i, d) in enumerate(rows)],
                                ", ".join(f"{c} string" for c in batch_load.BUSINESS_COLUMNS) + ", fecha_carga timestamp, archivo_origen string, row_seq bigint")
    stored = spark.createDataFrame([(1,), (2,), (3,)], "id_venta bigint")
    done = cleaning.outcome(raw, stored)
    assert {(r._raw_id, r.motivo) for r in done.collect()} == {
        (" 1", "DUPLICADO_EN_DWH"), ("2", "DUPLICADO_EN_DWH"), ("3.0", "DUPLICADO_EN_DWH"), ("4", "FECHA_INVALIDA"), (None, "ID_INVALIDO"), ("5", None)}
    good, bad = cleaning.split(cleaning.to_split(done))
    assert [r.id_venta for r in good.collect()] == [5]
    assert {r.id_venta for r in bad.collect()} == {" 1", "2", "3.0", "4", None}
