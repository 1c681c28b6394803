"""Both sample files through the whole load, with the recomputed figures."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from salesmart.operators import cleaning, facts, profiling, quality, reconcile, scd2
from salesmart.plans import analytics
from salesmart.plans.batch_load import CLOSED_T, RAW_T, Warehouse, run_summary
from salesmart.sources.csv_files import read_csv
from salesmart.sources.star import Star
from tests.sample_sales import INCREMENTAL, INITIAL, write_csv

DAY1, DAY2, DAY3 = datetime(2026, 3, 11), datetime(2026, 3, 12), datetime(2026, 3, 13)


def star_of(house):
    d = house.dims()
    return Star(fact=house.fact(), cliente=house.customers(), **{
        k.removeprefix("dim_"): v for k, v in d.items() if k != "dim_cliente"})


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("golden")
    first = write_csv(folder, "ventas_raw.csv", INITIAL)
    second = write_csv(folder, "ventas_nuevas.csv", INCREMENTAL)
    house = Warehouse(spark, str(folder / "house"))
    house.seed()
    house.seed()
    one = house.run_csv(first, "initial", "b1", DAY1)
    initial = {r.nombre_ciudad: (int(r.monto_total), r.total_transacciones)
               for r in analytics.city_analysis(star_of(house)).collect()}
    sellers = {r.nombre_vendedor: r["nivel_desempeño"]
               for r in analytics.seller_ranking(star_of(house)).collect()}
    two = house.run_csv(second, "incremental", "b2", DAY2)
    return house, one, two, initial, sellers, second


def test_counts_and_amount(loaded):
    house, one, two, *_ = loaded
    assert (one.extracted, one.clean, one.rejected, one.loaded, one.unresolved) == (20, 17, 3, 17, 0)
    assert (two.extracted, two.clean, two.rejected, two.loaded) == (9, 7, 2, 7)
    assert round(one.score, 4) == 0.9867
    total = house.fact().agg(F.count(F.lit(1)), F.sum("monto_total"), F.sum("cantidad"),
                             F.count_distinct("cliente_key")).first()
    assert tuple(map(int, total)) == (24, 1801000, 56, 18)
    first = house.fact().where("id_batch = 'b1'").agg(F.sum("monto_total")).first()[0]
    assert int(first) == 1291000
    assert run_summary(two, house.spark).first().en_fact == 7


def test_seeds_once_and_new_members(loaded):
    house = loaded[0]
    assert [house.members(n).count() for n in ("dim_canal", "dim_ciudad", "dim_producto", "dim_vendedor")] == [3, 8, 12, 6]
    assert house.customers().count() == 18
    assert scd2.broken_history(house.customers()).isEmpty()


def test_city_figures(loaded):
    house, *_, = loaded
    assert loaded[3] == {"Bogotá": (650000, 7), "Medellín": (355000, 4), "Cali": (211000, 4), "Barranquilla": (75000, 2)}
    rows = {r.nombre_ciudad: (int(r.monto_total), r.total_transacciones, r.ranking_nacional)
            for r in analytics.city_analysis(star_of(house)).collect()}
    assert rows == {"Bogotá": (920000, 10, 1), "Medellín": (475000, 6, 2), "Cali": (241000, 5, 3),
                    "Cartagena": (90000, 1, 4), "Barranquilla": (75000, 2, 5)}


def test_channel_seller_and_customer_figures(loaded):
    star = star_of(loaded[0])
    channels = {r.nombre_canal: (int(r.monto_total), r.total_transacciones, int(r.ticket_promedio), int(r.costo_comision))
                for r in analytics.channel_analysis(star).collect()}
    assert channels == {"Online": (1086000, 13, 83538, 0), "Marketplace": (360000, 4, 90000, 18000),
                        "Tienda": (355000, 7, 50714, 0)}
    sellers = {r.nombre_vendedor: (int(r.monto_total), r["nivel_desempeño"]) for r in analytics.seller_ranking(star).collect()}
    assert sellers == {"Juan Pérez": (615000, "Alto"), "Ana Torres": (305000, "Alto"), "Laura Díaz": (301000, "Medio"),
                       "Roberto Vega": (165000, "Medio"), "Camilo Rojas": (130000, "Bajo")}
    assert loaded[4] == {"Juan Pérez": "Alto", "Laura Díaz": "Alto", "Ana Torres": "Medio",
                         "Camilo Rojas": "Medio", "Roberto Vega": "Bajo"}
    top = [(r.ranking, r.id_cliente, int(r.monto_total)) for r in analytics.top_customers(star).collect()]
    # a tie at rank five gives six rows
    assert top == [(1, 2001, 360000), (2, 2002, 305000), (3, 2003, 225000), (4, 2020, 140000),
                   (5, 2018, 90000), (5, 2019, 90000)]


def test_product_and_month_figures(loaded):
    star = star_of(loaded[0])
    products = {r.id_producto: (r.total_unidades, int(r.monto_total), r.rank_por_monto)
                for r in analytics.product_analysis(star).collect()}
    assert products[502] == (13, 585000, 1) and products[501] == (10, 350000, 2)
    assert products[503] == (11, 165000, 3) and products[506] == (3, 165000, 3)
    month = analytics.monthly_trend(star).collect()
    assert [(r.anio, r.mes, r.total_transacciones, int(r.monto_total), r.variacion_pct) for r in month] == [
        (2024, "Enero", 24, 1801000, 0.0)]
    assert {r.tendencia for r in analytics.product_yoy(star).collect()} == {"Primer año"}
    view = analytics.sales_view(star)
    assert len(view.columns) == 24 and view.count() == 24


def test_rejections_in_order(spark, tmp_path):
    raw = read_csv(spark, write_csv(tmp_path, "ventas_raw.csv", INITIAL)).withColumn("fecha_carga", F.lit(DAY1))
    good, bad = cleaning.clean(raw)
    assert {(r.id_venta, r.motivo) for r in bad.collect()} == {
        ("1005", "FECHA_INVALIDA"), ("1004", "PRECIO_INVALIDO"), ("1008", "CANTIDAD_INVALIDA")}
    fixed = {r.id_venta: r for r in good.collect()}
    assert fixed[1003].fecha == date(2024, 1, 6) and fixed[1003].canal == "Online"
    assert fixed[1003].vendedor == fixed[1012].vendedor == "SIN_ASIGNAR"
    assert {r.motivo for r in cleaning.profile_clean(raw)[1].collect()} == {
        "FECHA_INVALIDA", "PRECIO_NULO", "CANTIDAD_INVALIDA"}


def test_scores_and_profile(spark, tmp_path):
    raw = read_csv(spark, write_csv(tmp_path, "ventas_raw.csv", INITIAL)).withColumn("fecha_carga", F.lit(DAY1))
    assert quality.score_mean_of_rules(quality.quality_log(raw)).first()[0] == 0.9867
    assert quality.score_pooled(quality.profile_log(raw)).first()[0] == 0.9921
    governance = spark.createDataFrame(
        [("COMPLETENESS:a", 200, 190), ("VALIDITY:a", 200, 190), ("UNIQUENESS:a", 200, 195), ("CONSISTENCY:a", 200, 200)],
        "regla_calidad string, registros_evaluados bigint, registros_validos bigint")
    assert quality.score_dimensions(governance).first()[0] == 96.875
    with pytest.raises(quality.QualityGateError):
        quality.check_gate(0.7)
    report = profiling.full_report(raw, spark.createDataFrame([(1015,)], "id_venta bigint"))
    assert report["score"].first().pass_threshold
    numbers = {r.columna: r for r in report["numericas"].collect()}
    assert float(numbers["cantidad"].min) == -2 and numbers["cantidad"].mediana == 2
    assert numbers["id_venta"].media == 1010.5 and numbers["precio_unitario"].mediana == 35000
    bounds = {r.columna: (r.desde, r.hasta) for r in profiling.iqr_bounds(raw).collect()}
    assert bounds["cantidad"] == (-2.0, 6.0)
    assert report["outliers"].isEmpty()
    columns = {r.columna: (r.nulos, r.distintos, r.valor_mas_comun) for r in report["por_columna"].collect()}
    assert columns["vendedor"][0] == 2 and columns["precio_unitario"][0] == 1
    assert columns["canal"] == (0, 5, "Online")
    stats = report["stats"].first()
    assert (stats.total_registros, stats.total_columnas, stats.duplicados_id_venta) == (20, 11, 0)
    kinds = {(r.tipo, r.id_venta) for r in report["issues"].collect()}
    assert {("FECHA_INVALIDA", "1005"), ("VALOR_FUERA_RANGO", "1008"), ("NULO_EN_CAMPO_REQUERIDO", "1004"),
            ("CANAL_CAPITALIZACIÓN_INCORRECTA", "1003")} <= kinds
    assert [r.tipo for r in report["key_issues"].collect()] == ["DUPLICADO_ENTRE_ARCHIVOS"]


def test_rerun_reconcile_rollback(loaded):
    house, second = loaded[0], loaded[5]
    def content(df):
        return sorted(map(tuple, df.drop("venta_key").collect()), key=str)
    before_fact, before_customers = content(house.fact()), content(house.customers())
    house.run_csv(second, "incremental", "b2", DAY2)
    assert content(house.fact()) == before_fact and content(house.customers()) == before_customers

    dims = {**house.dims(), "dim_cliente": house.customers()}
    assert [r.filas for r in reconcile.orphans(house.fact(), dims).collect()] == [0] * 6
    assert reconcile.amount_mismatch(house.fact()).isEmpty()
    sides = {(r.origen, r.id_batch): r.total_registros
             for r in reconcile.stage_vs_fact(house.clean(), house.fact()).collect()}
    assert sides[("staging_clean", "b2")] == sides[("fact_ventas", "b2")] == 7
    assert {r.estado for r in house.run_log().collect()} == {"EXITOSO"}

    # a move by customer 2001 in a third batch, then undone
    third = house.raw().where("id_venta = '1021'").drop("fecha_carga", "id_batch").withColumns(
        {"id_venta": F.lit("1030"), "ciudad": F.lit("Leticia")})
    third = house.spark.createDataFrame(third.collect(), third.schema)
    result = house.run(third, "incremental", "b3", DAY3)
    assert result.loaded == 1 and house.members("dim_ciudad").count() == 9
    versions = house.customers().where("id_cliente = 2001").orderBy("fecha_vigencia_desde").collect()
    assert [(v.ciudad, v.es_registro_actual, v.fecha_vigencia_hasta) for v in versions] == [
        ("Bogotá", False, date(2026, 3, 12)), ("Leticia", True, None)]
    with pytest.raises(ValueError):
        house.rollback("b1", DAY3)
    house.rollback("b3", DAY3)
    strip = lambda df: sorted(map(tuple, df.drop("venta_key", "fecha_actualizacion").collect()), key=str)
    assert content(house.fact()) == before_fact
    assert len(strip(house.customers())) == len(before_customers)
    assert scd2.broken_history(house.customers()).isEmpty()
    assert house.run_log().where("estado = 'REVERTIDO'").count() == 6
    assert house.store.batches(CLOSED_T) != ["b3"]


def test_failed_gate_is_logged(loaded, tmp_path):
    house = loaded[0]
    path = write_csv(tmp_path, "malo.csv", "x,2024-99-99,,,,,,,,,\n" * 3)
    with pytest.raises(quality.QualityGateError):
        house.run_csv(path, "initial", "malo", DAY1)
    states = [(r.proceso, r.estado) for r in house.run_log().where("id_batch = 'malo'").collect()]
    assert ("validate", "FALLIDO") in states
    assert house.fact().where("id_batch = 'malo'").isEmpty()


def test_retention_and_privacy_jobs(loaded, tmp_path):
    house = loaded[0]
    house.store.drop_batch(RAW_T, "malo")
    request = house.spark.createDataFrame([(2003,)], "id_cliente bigint")
    report = {(r.campo, r.valor) for r in house.portability(request, "dpo", DAY3).collect()}
    assert ("email_cliente", "carlos.ruiz@email.com") in report and len(report) == 6
    assert house.erase_customers(request, "dpo", DAY3) == 1
    for table in (house.customers(), house.raw(), house.clean()):
        rows = table.where("cast(id_cliente as bigint) = 2003").collect()
        assert rows and all(r.email_cliente == "cliente_2003@anonimo.test" for r in rows)
        assert all(r.telefono_cliente == "**********" for r in rows)
    assert house.raw().count() == 29 and house.clean().count() == 24
    audit = {(r.tabla_accedida, r.operacion, r.filas_afectadas) for r in house.access_log().collect()}
    assert ("DERECHO_AL_OLVIDO_COMPLETADO:id_cliente=2003", "DELETE", 1) in audit and ("PORTABILIDAD", "SELECT", None) in audit
    house.write_test_copy()
    copy = house.spark.read.parquet(house.store.path("test_data/ventas_anonimo"))
    assert copy.count() == 24 and copy.where("email_cliente like '%@email.com'").isEmpty()
    house.export_quality_log(str(tmp_path / "log"))
    assert house.spark.read.json(str(tmp_path / "log")).count() > 30
    from salesmart.schemas import RAW
    assert house.store.expire(RAW_T, RAW, "fecha_carga", 7, datetime(2026, 3, 18, 12)) == 1
    assert house.store.batches(RAW_T) == ["b2"]


def test_unresolved_rows_make_a_partial_load(loaded):
    house = loaded[0]
    row = house.clean().where("id_venta = 1001").withColumn("fecha", F.lit(date(2035, 1, 1)))
    keyed = facts.resolve_keys(row, house.dims())
    assert facts.resolved(keyed).isEmpty()
    assert facts.unresolved(keyed).first().motivo.startswith("fecha_key no encontrado")
