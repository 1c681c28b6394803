"""Ranks, history, measures and access on small tables, against plain Python."""

from datetime import date, datetime
from decimal import Decimal

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from salesmart.operators import access, facts, profiling, scd2
from salesmart.operators.calendar import build_calendar
from salesmart.operators.cleaning import dedupe_first
from salesmart.operators.ranking import (assign_keys, exact_percentiles, with_ntile, with_rank,
                                         with_row_number)
from salesmart.plans import measures
from salesmart.schemas import CHANNEL, CITY, PRODUCT, SELLER
from salesmart.session import broadcast_if_small, is_small
from salesmart.sources.seeds import CHANNEL_ROWS, CITY_ROWS, PRODUCT_ROWS, SELLER_ROWS, seed_dimensions
from salesmart.sources.tables import Store


def test_unbounded_ranks_match_plain_sorting(spark):
    # a third of the rows share one value; values span several prefixes and signs
    rng = np.random.default_rng(7)
    amounts = [0] * 300 + [int(v) for v in rng.integers(-(1 << 50), 1 << 50, 300)] + [int(v) for v in rng.integers(0, 50, 300)]
    df = spark.createDataFrame([(i, Decimal(a) / 100) for i, a in enumerate(amounts)], "k bigint, m decimal(25,2)")
    got = {r.k: r for r in with_ntile(with_rank(with_rank(df, "m", "r"), "m", "d", method="dense"), 4, "m", "k", "t").collect()}
    ordered = sorted(range(len(amounts)), key=lambda i: (-amounts[i], i))
    distinct = sorted(set(amounts), reverse=True)
    for place, i in enumerate(ordered):
        assert got[i].r == 1 + sum(a > amounts[i] for a in amounts)
        assert got[i].d == 1 + distinct.index(amounts[i])
        assert got[i].t == place // (len(amounts) // 4) + 1
    numbered = {r.k: r.n for r in with_row_number(df, "m", "k", "n").collect()}
    assert [numbered[i] for i in ordered] == list(range(1, len(amounts) + 1))
    small = {r.k: (r.r, r.d) for r in with_rank(with_rank(df, "m", "r", bound=df), "m", "d", method="dense", bound=df).collect()}
    assert small == {k: (r.r, r.d) for k, r in got.items()}


def test_ntile_gives_the_remainder_to_the_first_tiles(spark):
    df = spark.createDataFrame([(i, i) for i in range(11)], "k bigint, m bigint")
    sizes = {}
    for r in with_ntile(df, 3, "m", "k", "t").collect():
        sizes[r.t] = sizes.get(r.t, 0) + 1
    assert sizes == {1: 4, 2: 4, 3: 3}
    few = spark.createDataFrame([(1, 5), (2, 3)], "k bigint, m bigint")
    assert sorted(r.t for r in with_ntile(few, 3, "m", "k", "t").collect()) == [1, 2]


def test_keys_are_consecutive(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("name")).repartition(7)
    rows = assign_keys(df, ["name"], "key", 41).orderBy("name").collect()
    assert [r.key for r in rows] == list(range(42, 1042))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10000, 10**9), min_size=1, max_size=60))
def test_percentiles_interpolate_like_numpy(spark, cents):
    df = spark.createDataFrame([("x", Decimal(c) / 100) for c in cents], "g string, v decimal(18,2)")
    row = exact_percentiles(df, "g", "v", {"q1": 0.25, "m": 0.5, "q3": 0.75}).first()
    want = np.percentile(np.array(cents) / 100, [25, 50, 75])
    assert np.allclose([row.q1, row.m, row.q3], want) and row.n == len(cents)


def test_outliers(spark):
    rows = [(str(i), "1", "10") for i in range(20)] + [("99", "500", "10"), ("98", "x", None)]
    raw = spark.createDataFrame(rows, "id_venta string, cantidad string, precio_unitario string")
    assert [(r.id_venta, r.columna) for r in profiling.iqr_outliers(raw).collect()] == [("99", "cantidad")]


def test_first_arrival_is_kept(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 2, "a"), (2, 9, "c")], "id_venta bigint, o int, v string")
    assert {(r.id_venta, r.v) for r in dedupe_first(df, "id_venta", ("o",)).collect()} == {(1, "a"), (2, "c")}
    plan = dedupe_first(df, "id_venta", ("o",))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # hot keys shrink before the shuffle


HISTORY = ("cliente_key bigint, id_cliente bigint, email_cliente string, telefono_cliente string, ciudad string, "
           "fecha_vigencia_desde date, fecha_vigencia_hasta date, es_registro_actual boolean, fecha_creacion timestamp, "
           "fecha_actualizacion timestamp, id_batch_open string, id_batch_close string")
INCOMING = "id_cliente bigint, email_cliente string, telefono_cliente string, ciudad string"


def test_history_merge_same_day_and_nulls(spark):
    t0 = datetime(2024, 1, 1)
    history = spark.createDataFrame([
        (1, 10, "a@x.co", None, "Cali", date(2024, 1, 1), None, True, t0, None, "b0", None),
        (2, 20, "b@x.co", "1", "Cali", date(2024, 1, 1), None, True, t0, None, "b0", None)], HISTORY)
    day = date(2024, 5, 1)
    # blank equals missing; 20 moves; 30 is new
    first = scd2.scd2_merge(history, spark.createDataFrame(
        [(10, "a@x.co", " ", "Cali"), (20, "b@x.co", "1", "Pasto"), (30, None, None, "Neiva")], INCOMING), day, "b1")
    first = spark.createDataFrame(first.collect(), HISTORY)
    assert {(r.cliente_key, r.id_cliente, r.ciudad, r.es_registro_actual, r.fecha_vigencia_hasta) for r in first.collect()} == {
        (1, 10, "Cali", True, None), (2, 20, "Cali", False, date(2024, 4, 30)), (3, 20, "Pasto", True, None), (4, 30, "Neiva", True, None)}
    again = scd2.scd2_merge(first, spark.createDataFrame([(20, "b@x.co", "1", "Tunja")], INCOMING), day, "b2")
    versions = {(r.cliente_key, r.ciudad, r.es_registro_actual) for r in again.where("id_cliente = 20").collect()}
    assert versions == {(2, "Cali", False), (3, "Tunja", True)}
    assert scd2.broken_history(again).isEmpty()
    sales = spark.createDataFrame([(1, 20, date(2020, 1, 1)), (2, 20, date(2024, 4, 30)), (3, 20, day), (4, 77, day)],
                                  "id_venta bigint, id_cliente bigint, fecha date")
    assert {r.id_venta: r.cliente_key for r in scd2.as_of(sales, again).collect()} == {1: 2, 2: 2, 3: 3, 4: None}
    gap = again.withColumn("fecha_vigencia_desde", F.when(F.col("cliente_key") == 3, F.lit(date(2024, 6, 1)))
                           .otherwise(F.col("fecha_vigencia_desde")))
    assert [r.id_cliente for r in scd2.broken_history(gap).collect()] == [20]


SALES = [("x", date(2023, 1, 10), 100), ("x", date(2023, 3, 5), 50), ("x", date(2024, 1, 2), 80), ("x", date(2024, 2, 1), 20)]


def _sales(spark):
    return spark.createDataFrame([(g, d, Decimal(m)) for g, d, m in SALES], "g string, fecha_venta date, monto_total decimal(15,2)")


def test_period_measures_use_calendar_shifts(spark):
    mom = {r.mes: r for r in measures.month_over_month(_sales(spark), ["g"]).collect()}
    # March follows a month without sales
    assert mom[date(2023, 3, 1)].ventas_mes_anterior is None and mom[date(2023, 3, 1)].crecimiento_mom_pct == 0.0
    assert float(mom[date(2023, 3, 1)].crecimiento_mom) == 50
    assert mom[date(2024, 2, 1)].crecimiento_mom_pct == -0.75 and mom[date(2024, 2, 1)].variacion_mom_texto == "▼ 75.0%"
    assert mom[date(2024, 2, 1)].etiqueta_mes == "Feb 2024"
    ytd = {r.mes: r for r in measures.year_to_date(_sales(spark), ["g"]).collect()}
    assert float(ytd[date(2024, 2, 1)].ventas_ytd) == 100
    # February 2023 had no sales, its running sum is January's
    assert float(ytd[date(2024, 2, 1)].ventas_ytd_anio_anterior) == 100
    yoy = {r.mes: r.crecimiento_yoy_pct for r in measures.year_over_year(_sales(spark), ["g"]).collect()}
    assert yoy[date(2024, 1, 1)] == -0.2


def test_row_and_column_filters(spark):
    sellers = spark.createDataFrame([(1, "Andina", "a@v"), (2, "Andina", "b@v"), (3, None, "c@v")],
                                    "vendedor_key bigint, region string, email_vendedor string")
    fact = spark.createDataFrame([(i, i % 3 + 1) for i in range(9)], "id_venta bigint, vendedor_key bigint")
    seen = lambda role, user: access.rows_for(role, fact, sellers, user).count()
    assert [seen("admin", "x"), seen("seller", "a@v"), seen("report", "a@v"), seen("report", "c@v"),
            seen("report", "nobody"), seen("stranger", "a@v")] == [9, 3, 6, 0, 0, 0]
    people = spark.createDataFrame([(1, "ana@x.co", "3001234567")], "id_cliente bigint, email_cliente string, telefono_cliente string")
    assert access.columns_for("report", people).first().email_cliente == "***@x.co"
    assert access.columns_for("stranger", people).columns == ["id_cliente"]


def test_broadcast_needs_a_small_bound(spark):
    small = spark.range(10)
    assert is_small(small) and not is_small(small, limit=1)
    hinted = lambda df: "ResolvedHint" in df.join(broadcast_if_small(small, limit=limit), "id")._jdf.queryExecution().analyzed().toString()
    limit = 10_000
    assert hinted(small)
    limit = 1
    assert not hinted(small)


def test_sales_are_not_shuffled_by_seeded_names(spark):
    """Seeds are known to be small: a join by channel or city would deal all sales to a task per name."""
    seeds = seed_dimensions(spark)
    for name, schema, rows in (("dim_canal", CHANNEL, CHANNEL_ROWS), ("dim_ciudad", CITY, CITY_ROWS),
                               ("dim_producto", PRODUCT, PRODUCT_ROWS), ("dim_vendedor", SELLER, SELLER_ROWS)):
        assert is_small(seeds[name])
        assert seeds[name].schema == spark.createDataFrame([], schema).schema
        assert [(r[0], r[1 + (name == "dim_producto")]) for r in seeds[name].collect()] == [
            (i, row[name == "dim_producto"]) for i, row in enumerate(rows, 1)]
    customers = spark.range(1, 4).select(F.col("id").alias("id_cliente"), F.col("id").alias("cliente_key"),
                                         F.lit(True).alias("es_registro_actual"))
    sales = spark.range(1 << 40).select(
        F.col("id").alias("id_venta"), F.lit(date(2024, 1, 5)).alias("fecha"), F.lit(501).cast("bigint").alias("id_producto"),
        (F.col("id") % 5).alias("id_cliente"), F.concat(F.lit("Onlin"), F.chr(F.col("id") % 3 + 100)).alias("canal"),
        F.concat(F.lit("Cal"), F.chr(F.col("id") % 3 + 104)).alias("ciudad"), F.lit("SIN_ASIGNAR").alias("vendedor"))
    dims = {"dim_fecha": build_calendar(spark), "dim_cliente": customers, **seeds}
    for join in (facts.star_rows, facts.resolve_keys):
        plan = join(sales, dims)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(ca" not in plan and "Exchange hashpartitioning(ci" not in plan
        assert "SortMergeJoin" not in plan
    # Online and Cali come together in every third sale, a known customer in three of five
    assert {r.id_venta for r in facts.star_rows(sales.where("id_venta < 30"), dims).collect()} == {
        i for i in range(30) if i % 3 == 1 and i % 5 in (1, 2, 3)}


def test_store_versions_and_batches(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = "a bigint, id_batch string"
    assert store.read("t", schema).isEmpty()
    for _ in range(2):
        store.overwrite_batch("t", spark.createDataFrame([(1, "x")], schema), "x")
    store.overwrite_batch("t", spark.createDataFrame([(2, "y")], schema), "y")
    assert sorted(map(tuple, store.read("t", schema).collect())) == [(1, "x"), (2, "y")]
    plan = store.read_batch("t", schema, "x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_batch" in plan
    store.overwrite_batch("t", spark.createDataFrame([], schema), "y")
    assert store.read("t", schema).count() == 1
    for v in range(3):
        store.write_snapshot("s", spark.createDataFrame([(v,)], "a bigint"))
    assert store.read_snapshot("s", "a bigint").first().a == 2
    assert store.read_snapshot("s", "a bigint", back=1).first().a == 1
    assert len(store.versions("s")) == 2
