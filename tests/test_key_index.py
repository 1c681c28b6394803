"""The key index: what it holds, what a lookup reads, and the load that uses it; manifests and counts taken while writing."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrame, functions as F

from salesmart.operators import key_index
from salesmart.plans.batch_load import CLEAN_T, FACT_T, KEY_INDEX_T, KEYED_T, RAW_T, Warehouse
from salesmart.schemas import CLEAN, FACT, RAW
from salesmart.sources.tables import Store
from tests.test_rollback import DAYS, sales, sound


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id_venta bigint")


def found(index, wanted):
    return sorted(r.id_venta for r in key_index.known_keys(index, wanted).collect())


@pytest.mark.parametrize("case", ["dense", "interleaved", "sparse", "edges"])
def test_exactly_the_stored_keys_are_found(spark, case):
    rng = random.Random(case)
    stored = {"dense": set(range(1, 100_000)), "interleaved": set(range(1, 200_000, 2)),
              "sparse": {rng.randrange(1, 1 << 62) for _ in range(3000)},
              "edges": {1, 32768, 32769, 65536, 65537, (1 << 63) - 1, *range(100_000, 101_500)}}[case]
    wanted = list(rng.sample(sorted(stored), min(len(stored), 500))) + [k + 1 for k in rng.sample(sorted(stored), 6) if k < 1 << 62]
    wanted += [wanted[0], None, 32768, 32769, 5]
    index = key_index.key_bitmaps(keys(spark, [*stored, None, min(stored)]).repartition(4))
    assert key_index.keys_in(index).agg(F.sum("n")).first()[0] == len(stored)
    assert index.where("(bits is null) = (places is null)").isEmpty()
    assert index.where(f"size(places) > {key_index.MOST_PLACES} or octet_length(bits) <> 4096").isEmpty()
    assert found(index, keys(spark, wanted)) == sorted(set(wanted) & stored)


def test_several_batches_empty_index_and_nothing_wanted(spark):
    one, two = key_index.key_bitmaps(keys(spark, range(1, 5000, 2))), key_index.key_bitmaps(keys(spark, [2, 4, 9000]))
    both = one.unionByName(two)
    assert found(both, keys(spark, [1, 2, 3, 4, 6, 9000, 9001])) == [1, 2, 3, 4, 9000]
    assert found(both, keys(spark, [])) == found(both.limit(0), keys(spark, [1])) == found(both, keys(spark, [None])) == []


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    made = Warehouse(spark, str(tmp_path_factory.mktemp("index") / "house"))
    made.seed()
    rows = lambda ids: sales(spark, *[(i, 1000 + i % 7, "Cali", "a@uno.co") for i in ids])
    made.run(rows(range(1, 200, 2)), "initial", "b1", DAYS[0])
    made.rows = rows
    return made


def test_a_load_counts_while_it_writes_and_reads_no_stored_keys(spark, house, monkeypatch):
    """No ``count`` runs, and ids that lie between the stored ones are told apart by the index alone."""
    monkeypatch.setattr(DataFrame, "count", lambda self: pytest.fail("a load must not count"))
    result = house.run(house.rows([*range(2, 100, 2), 1, 3, 5]), "incremental", "b2", DAYS[1], threshold=0.5)
    monkeypatch.undo()
    assert (result.extracted, result.clean, result.rejected, result.loaded, result.skipped) == (52, 49, 3, 49, 0)
    assert house.fact().count() == house.fact().select("id_venta").distinct().count() == 149
    lookup = house.stored_keys(keys(spark, [1, 2, 500]), "b9")
    assert sorted(r.id_venta for r in lookup.collect()) == [1, 2]
    assert all(f"/{KEY_INDEX_T}/" in path for path in house.store.read_other(KEY_INDEX_T, key_index.KEY_INDEX, "b9").inputFiles())
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert f"{KEY_INDEX_T}" in plan and f"{FACT_T}]" not in plan and f"{FACT_T}/" not in plan


def test_a_batch_without_index_gets_one_and_a_rollback_takes_it_away(spark, house):
    house.run(house.rows([301, 303]), "incremental", "b3", DAYS[2])
    house.store.drop_batch(KEY_INDEX_T, "b3")  # cut off between the fact and its index
    result = house.run(house.rows([301, 302]), "incremental", "b4", DAYS[3], threshold=0.5)
    assert (result.rejected, result.loaded) == (1, 1)
    house.rollback("b4", DAYS[4])
    house.rollback("b3", DAYS[4])
    assert not {"b3", "b4"} & set(house.store.batches(KEY_INDEX_T))
    assert house.run(house.rows([301, 302]), "incremental", "b5", DAYS[5]).loaded == 2
    sound(house)


def test_footprint_and_expiry_read_no_rows(spark, house, monkeypatch):
    before = {(r.tabla, r.id_batch): r.registros for r in house.footprint().collect()}
    assert before[RAW_T, "b1"] == before[FACT_T, "b1"] == before[KEYED_T, "b1"] == 100
    monkeypatch.setattr(Store, "read", lambda *a: pytest.fail("reads rows"))
    assert {(r.tabla, r.id_batch): r.registros for r in house.footprint().collect()} == before
    oldest = min(r.mas_antiguo for r in house.footprint().where(F.col("tabla") == CLEAN_T).collect())
    assert oldest == DAYS[0]
    assert house.store.expire(CLEAN_T, CLEAN, "fecha_procesamiento", 7, DAYS[0] + timedelta(days=7)) == 0
    assert house.store.expire(CLEAN_T, CLEAN, "fecha_procesamiento", 7, DAYS[0] + timedelta(days=7, seconds=1)) == 1
    monkeypatch.undo()
    assert "b1" not in house.store.batches(CLEAN_T)


def test_manifests_follow_what_is_written(spark, tmp_path):
    store, name = Store(spark, str(tmp_path)), RAW_T
    row = lambda day: ("1", *[None] * 10, datetime(2026, 1, day), "f", 1)
    frame = lambda *days: spark.createDataFrame([row(d) for d in days], RAW.replace(", id_batch string", ""))
    assert store.manifests(name, RAW) == {}
    assert store.overwrite_batch(name, frame(3, 9), "a", {"otras": F.count_if(F.lit(False))})["filas"] == 2
    assert store.overwrite_batch(name, frame().limit(0), "empty")["filas"] == 0
    store.append_batch(name, frame(1), "a")  # what was known no longer holds
    assert {b: m["filas"] for b, m in store.manifests(name, RAW).items()} == {"a": 3, "empty": 0}
    # rows of several days: only the old ones go, and the manifest says so
    assert store.expire(name, RAW, "fecha_carga", 10, datetime(2026, 1, 15)) == 1
    assert store.manifests(name, RAW)["a"]["filas"] == 1 and store.read_batch(name, RAW, "a").count() == 1
    store.drop_batch(name, "a")
    assert set(store.manifests(name, RAW)) == {"empty"}
    assert store.read(FACT_T, FACT).isEmpty()
