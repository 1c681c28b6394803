"""Rollback and erasure where batches build on each other."""

import shutil
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart.operators import reconcile, scd2
from salesmart.plans.batch_load import ACTIVE_T, CLOSED_T, KEYED_T, PREVIOUS_T, RAW_T, REJECT_T, Warehouse
from salesmart.schemas import BUSINESS_COLUMNS, CUSTOMER

DAYS = [datetime(2026, 3, d, 8) for d in range(1, 9)]


def sales(spark, *rows):
    """Rows of (sale, customer, city, e-mail) as raw text."""
    full = [(str(s), "2024-01-05", str(c), "501", "2", "100.00", "Online", city, "Ana Torres", mail, "3001234567")
            for s, c, city, mail in rows]
    frame = spark.createDataFrame(full, ", ".join(f"{c} string" for c in BUSINESS_COLUMNS))
    return frame.withColumns({"archivo_origen": F.lit("f.csv"), "row_seq": F.monotonically_increasing_id()})


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    made = Warehouse(spark, str(tmp_path_factory.mktemp("rollback") / "house"))
    made.seed()
    made.run(sales(spark, (1, 7, "Cali", "siete@uno.co"), (2, 8, "Cali", "ocho@uno.co")), "initial", "b1", DAYS[0])
    return made


@pytest.fixture
def house(spark, first, tmp_path):
    shutil.copytree(first.store.root, tmp_path / "house")
    return Warehouse(spark, str(tmp_path / "house"))


def state(house, *without):
    return sorted(map(tuple, house.customers().drop("fecha_actualizacion", *without).collect()), key=str)


def sound(house):
    dims = {**house.dims(), "dim_cliente": house.customers()}
    assert scd2.broken_history(house.customers()).isEmpty()
    assert {r.filas for r in reconcile.orphans(house.fact(), dims).collect()} == {0}


def test_refused_when_later_sales_use_its_customers_and_no_key_is_given_twice(spark, house):
    house.run(sales(spark, (3, 9, "Cali", "nueve@uno.co")), "incremental", "b2", DAYS[1])
    house.run(sales(spark, (4, 9, "Cali", "nueve@uno.co")), "incremental", "b3", DAYS[2])
    with pytest.raises(ValueError, match="sold to"):
        house.rollback("b2", DAYS[3])
    sound(house)
    house.rollback("b3", DAYS[3])
    used = {r.cliente_key for r in house.customers().collect()}
    sold = {r.venta_key for r in house.fact().collect()}
    house.rollback("b2", DAYS[3])
    sound(house)
    house.run(sales(spark, (5, 77, "Cali", "otro@uno.co")), "incremental", "b4", DAYS[4])
    assert house.customers().where("id_cliente = 77").first().cliente_key not in used
    assert house.fact().where("id_venta = 5").first().venta_key not in sold
    sound(house)


def test_repeated_after_a_crash(spark, house):
    before = state(house)
    house.run(sales(spark, (3, 7, "Pasto", "siete@uno.co")), "incremental", "b2", DAYS[1])
    closed = house.store.read_batch(CLOSED_T, CUSTOMER + ", id_batch string", "b2").collect()
    assert len(closed) == 1
    # cut off between the snapshot and the drop of the closed versions
    restored = scd2.undo_batch(house.customers(), "b2", F.lit(DAYS[2]).cast("timestamp")).where("es_registro_actual")
    house.store.write_snapshot(ACTIVE_T, restored)
    house.rollback("b2", DAYS[2])
    assert state(house) == before
    house.rollback("b2", DAYS[2])
    assert state(house) == before
    sound(house)


def test_edits_of_the_same_day_are_undone(spark, house):
    before = sorted(map(tuple, house.customers().collect()), key=str)
    late = DAYS[0].replace(hour=20)
    house.run(sales(spark, (3, 7, "Pasto", "nuevo@dos.co")), "incremental", "b2", late)
    house.run(sales(spark, (3, 7, "Pasto", "nuevo@dos.co")), "incremental", "b2", late)  # again: the record stays
    assert house.customers().where("id_cliente = 7").first().email_cliente == "nuevo@dos.co"
    house.run(sales(spark, (4, 7, "Tunja", "tercero@tres.co")), "incremental", "b3", late.replace(hour=22))
    with pytest.raises(ValueError, match="edited"):
        house.rollback("b2", DAYS[1])
    house.rollback("b3", DAYS[1])
    assert house.customers().where("id_cliente = 7").first().ciudad == "Pasto"
    house.rollback("b2", DAYS[1])
    assert sorted(map(tuple, house.customers().collect()), key=str) == before
    assert PREVIOUS_T and not house.store.batches(PREVIOUS_T)


def test_rerun_gives_the_same_keys(spark, house):
    rows = sales(spark, (3, 9, "Neiva", "nueve@uno.co"), (4, 7, "Pasto", "siete@uno.co"))
    house.run(rows, "incremental", "b2", DAYS[1])
    house.run(sales(spark, (6, 10, "Cali", "diez@uno.co")), "incremental", "b3", DAYS[2])
    for name in ("dim_canal", "dim_ciudad", "dim_vendedor", "dim_producto"):  # b3 brings no member
        assert "b3" not in house.store.batches(f"dwh/{name}")
    facts, customers = sorted(map(tuple, house.fact().collect())), state(house)
    house.run(rows, "incremental", "b2", DAYS[1])
    assert sorted(map(tuple, house.fact().collect())) == facts and state(house) == customers


def test_attempts_stay_in_the_log(spark, house, monkeypatch):
    long = "x" * 2000
    monkeypatch.setattr(house, "_load_fact", lambda *a: (_ for _ in ()).throw(RuntimeError(long)))
    with pytest.raises(RuntimeError):
        house.run(sales(spark, (3, 9, "Cali", "n@u.co")), "incremental", "b2", DAYS[1])
    monkeypatch.undo()
    house.run(sales(spark, (3, 9, "Cali", "n@u.co")), "incremental", "b2", DAYS[2])
    log = house.run_log().where("id_batch = 'b2'")
    assert log.where("estado = 'FALLIDO'").first().mensaje_error == long
    assert log.where("proceso = 'fact' and estado = 'EXITOSO'").count() == 1
    assert log.where("estado = 'INICIADO'").isEmpty()


def test_erasure_leaves_no_file_with_the_data(spark, house):
    raw = sales(spark, (3, 7, "Pasto", "siete@dos.co"), (4, 9, "Cali", "nueve@uno.co"))
    raw = raw.withColumn("id_cliente", F.when(F.col("id_cliente") == "7", " 7.0").otherwise(F.col("id_cliente")))
    house.run(raw, "incremental", "b2", DAYS[1])
    house.run(sales(spark, (5, 7, "Tunja", "siete@tres.co")), "incremental", "b3", DAYS[1].replace(hour=22))
    assert house.erase_customers(spark.createDataFrame([(7,), (99,)], "id_cliente bigint"), "dpo", DAYS[2]) == 2
    files = [str(p) for p in Path(house.store.root).rglob("*.parquet")]
    assert len(files) > 20
    for path in files:
        for row in spark.read.parquet(path).collect():
            assert not any(isinstance(v, str) and "siete@" in v for v in row), path
    assert house.raw().where("email_cliente = 'nueve@uno.co'").count() == 1
    logged = {(r.tabla_accedida, r.filas_afectadas) for r in house.access_log().collect()}
    assert {("DERECHO_AL_OLVIDO_COMPLETADO:id_cliente=7", 2), ("DERECHO_AL_OLVIDO_COMPLETADO:id_cliente=99", 0)} <= logged
    house.rollback("b3", DAYS[3])
    assert house.customers().where("id_cliente = 7 and es_registro_actual").first().email_cliente == "cliente_7@anonimo.test"


def test_keyed_and_rejected_rows_expire(spark, house):
    house.run(sales(spark, ("x", 7, "Cali", "s@u.co"), (3, 7, "Cali", "siete@uno.co")), "incremental", "b2", DAYS[1],
              threshold=0.1)
    assert house.store.batches(REJECT_T) == ["b1", "b2"] and "email_cliente" not in house.spark.read.parquet(
        house.store.path(KEYED_T)).columns
    house.run(sales(spark, (9, 7, "Cali", "siete@uno.co")), "incremental", "b9", datetime(2026, 6, 1))
    assert house.store.batches(KEYED_T) == ["b9"] and house.store.batches(RAW_T) == ["b9"]
    assert "b2" not in house.store.batches(REJECT_T)
