"""Steps of the batch jobs whose plans must not gather a batch, or its rows, in one place."""

from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from checks.queries import _copy_of
from salesmart.operators import key_index, privacy
from salesmart.operators.ranking import assign_keys
from salesmart.plans.batch_load import Warehouse
from test_rollback import sales


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def loaded(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.seed()
    house.run(sales(spark, (1, 7, "Cali", "siete@uno.co"), (2, 8, "Cali", "ocho@uno.co")), "initial", "b1", datetime(2026, 3, 1))
    house.run(sales(spark, (3, 9, "Cali", "nueve@uno.co")), "incremental", "b2", datetime(2026, 3, 2))
    return house


def test_copy_of_a_warehouse_is_made_by_tasks(spark, tmp_path):
    house = loaded(spark, tmp_path)
    spark.sparkContext.setJobGroup("copy", "copy")
    try:
        copy = _copy_of(house)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("copy")
    def files(root):
        root = Path(root.removeprefix("file:"))
        return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert files(copy.store.root) == files(house.store.root)
    assert sorted(copy.fact().collect()) == sorted(house.fact().collect())


def test_erasure_deals_no_batch_to_one_task(spark, tmp_path, monkeypatch):
    house, seen, erase = loaded(spark, tmp_path), [], privacy.erase

    def spied(df, *rest):
        seen.append((df.columns, plan(df), {r[0] for r in df.select("id_batch").distinct().collect()} if "id_batch" in df.columns else None))
        return erase(df, *rest)

    monkeypatch.setattr(privacy, "erase", spied)
    assert house.erase_customers(spark.createDataFrame([(7,)], "id_cliente bigint"), "dpo", datetime(2026, 3, 5)) == 1
    batches = [(p, b) for columns, p, b in seen if "row_seq" in columns or "monto_total" in columns]
    assert len(batches) == 2
    for text, found in batches:  # only the batch with the customer, and no join that sends it by its name
        assert found == {"b1"} and "Join" not in text and "Exchange" not in text
    assert house.raw().where("email_cliente = 'siete@uno.co'").isEmpty()


def test_numbered_rows_are_not_shuffled_for_their_offsets(spark):
    rows = spark.range(0, 5000, 1, 8).withColumn("v", F.xxhash64("id"))
    numbered = assign_keys(rows, ["v"], "k")
    assert "SortMergeJoin" not in plan(numbered)
    want = {v: i for i, v in enumerate(sorted(r.v for r in rows.collect()), 1)}
    assert {r.v: r.k for r in numbered.collect()} == want


def test_scattered_keys_meet_at_their_bucket_first(spark):
    keys = spark.range(0, 200_000, 3, 16).select(F.col("id").alias("id_venta"))
    keys = keys.union(keys.limit(50)).union(spark.createDataFrame([(None,)], "id_venta bigint")).repartition(16)
    index = key_index.key_bitmaps(keys, scattered=True)
    assert sorted(index.collect()) == sorted(key_index.key_bitmaps(keys).collect())
    dealt = plan(index).split("== Initial Plan ==")[-1].split("Exchange hashpartitioning(bucket", 1)
    assert "bitmap_construct_agg" in dealt[0] and "bitmap_construct_agg" not in dealt[1]
