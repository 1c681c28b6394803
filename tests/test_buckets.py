"""Bucketed snapshots: what a write touches, what a cut-off write leaves, and the customer dimension kept that way."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart.plans.batch_load import ACTIVE_T, Warehouse
from salesmart.sources.tables import Store
from tests.test_rollback import DAYS, sales, sound, state

SCHEMA = "k bigint, v string"


def files(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path), {"t": ("k", 100)})
    made.write_snapshot("t", spark.range(5000).selectExpr("id as k", "'old' as v"))
    return made


def rows(store, **options):
    return dict(map(tuple, store.read_snapshot("t", SCHEMA, **options).collect()))


def test_a_write_touches_its_buckets_only(spark, store):
    before = files(store.path("t"))
    assert len(before) == 100
    changed = spark.createDataFrame([(7, "new"), (9000, "new")], SCHEMA)
    touched = store.buckets_of("t", changed)
    old = store.read_snapshot("t", SCHEMA, buckets=touched)
    assert len(old.inputFiles()) == len(touched) <= 2
    store.write_buckets("t", old.join(changed, "k", "left_anti").unionByName(changed), touched)
    made = files(store.path("t")) - before
    assert len(made) == len(touched) and before <= files(store.path("t"))
    now = rows(store)
    assert len(now) == 5001 and now[7] == now[9000] == "new" and now[8] == "old"
    assert rows(store, back=1)[7] == "old" and len(rows(store, back=1)) == 5000
    # a third write forgets what only the first manifest named
    store.write_buckets("t", store.read_snapshot("t", SCHEMA, buckets=touched), touched)
    assert len(files(store.path("t"))) == 100 + len(touched)
    assert rows(store) == now


def test_a_half_written_version_stays_unseen(spark, store, monkeypatch):
    before = rows(store)
    monkeypatch.setattr(store, "_write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
    with pytest.raises(RuntimeError):
        store.write_snapshot("t", spark.createDataFrame([(1, "lost")], SCHEMA))
    monkeypatch.undo()
    assert rows(store) == before
    touched = store.buckets_of("t", spark.createDataFrame([(1,)], "k bigint"))
    kept = store.read_snapshot("t", SCHEMA, buckets=touched).where("k <> 1")
    store.write_buckets("t", kept, touched)  # takes the folder that was left
    assert rows(store) == {k: v for k, v in before.items() if k != 1}


def test_rows_of_other_buckets_are_refused(spark, store):
    before = rows(store)
    touched = store.buckets_of("t", spark.createDataFrame([(1,)], "k bigint"))
    with pytest.raises(ValueError, match="of others"):
        store.write_buckets("t", store.read_snapshot("t", SCHEMA), touched)
    assert rows(store) == before


def test_emptied_buckets_null_keys_and_another_number_of_buckets(spark, store):
    everything = list(range(100))
    store.write_buckets("t", spark.createDataFrame([(None, "no key"), (3, "x")], SCHEMA), everything, keep=1)
    assert rows(store) == {None: "no key", 3: "x"}
    assert len(files(store.path("t"))) <= 2 and len(store.bucketed["t"].manifests()) == 1
    store.bucketed["t"].rebucket(SCHEMA, 7)
    again = Store(spark, store.root, {"t": ("k", 100)})
    assert rows(again) == {None: "no key", 3: "x"} and again.bucketed["t"].buckets == 7
    assert store.write_buckets("t", store.read_snapshot("t", SCHEMA), []) is None


def test_a_table_from_before_it_had_buckets(spark, tmp_path):
    Store(spark, str(tmp_path)).write_snapshot("t", spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA))
    store = Store(spark, str(tmp_path), {"t": ("k", 4)})
    assert rows(store) == {1: "a", 2: "b"}
    assert set(rows(store, buckets=store.buckets_of("t", spark.range(1, 2).withColumnRenamed("id", "k")))) >= {1}
    with pytest.raises(ValueError, match="no buckets yet"):
        store.write_buckets("t", spark.createDataFrame([(1, "c")], SCHEMA), [0])
    store.write_snapshot("t", store.read_snapshot("t", SCHEMA))
    assert rows(store) == {1: "a", 2: "b"} and not store.versions("t")


def test_customers_of_a_batch_rewrite_their_buckets_and_come_back_with_a_rollback(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"), customer_buckets=100)
    house.seed()
    many = [(i, 1000 + i, "Cali", f"c{i}@uno.co") for i in range(1, 301)]
    house.run(sales(spark, *many), "initial", "b1", DAYS[0])
    folder = Path(house.store.path(ACTIVE_T))
    first, before = files(folder), state(house)
    assert len(first) > 80
    # one customer moves, one is seen again as it is: one bucket is written
    house.run(sales(spark, (901, 1007, "Pasto", "c7@uno.co"), (902, 1008, "Cali", "c8@uno.co")), "incremental", "b2", DAYS[1])
    made = files(folder) - first
    assert len(made) == 1 and first <= files(folder)
    assert house.customers().where("id_cliente = 1007").count() == 2
    # nothing new: nothing is written
    now = files(folder)
    house.run(sales(spark, (903, 1008, "Cali", "c8@uno.co")), "incremental", "b3", DAYS[2])
    assert files(folder) == now
    house.rollback("b3", DAYS[3])
    house.rollback("b2", DAYS[3])
    assert state(house) == before
    sound(house)
    assert len(files(folder) - now) == 1
    house.erase_customers(spark.createDataFrame([(1009,)], "id_cliente bigint"), "dpo", datetime(2026, 4, 1))
    assert len(house.store.bucketed[ACTIVE_T].manifests()) == 1
    assert house.active().where(F.col("email_cliente") == "cliente_1009@anonimo.test").count() == 1
    assert house.active().count() == 300
