"""The analytical queries over a star.

Every query aggregates the fact by surrogate keys first and joins the
dimensions to the result, so no dimension is ever joined to raw fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.functions.dates import month_key
from salesmart.functions.normalize import UNASSIGNED
from salesmart.functions.numbers import growth_label, pct_change, tercile_label
from salesmart.operators.ranking import with_ntile, with_rank
from salesmart.session import is_small
from salesmart.sources.star import Star


def sale_count(fact: DataFrame) -> Column:
    """Number of sales: rows, or their count in a pre-summed fact."""
    return F.sum("n_ventas") if "n_ventas" in fact.columns else F.count(F.lit(1))


def average(total: str, count: str, digits: int = 0) -> Column:
    return F.round(F.col(total).cast("double") / F.col(count), digits)


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def top_customers(star: Star, top: int = 5, by_id: bool = False) -> DataFrame:
    """Best customers by amount; ties share a rank, so more than ``top`` may come.

    As the reports define it only sales of the current customer version
    count; ``by_id`` adds up the sales of all versions of a customer.
    """
    fact = star.totals()
    sums = fact.groupBy("cliente_key").agg(
        sale_count(fact).alias("total_transacciones"), F.sum("monto_total").alias("monto_total"),
        F.min("fecha_venta").alias("primera_compra"), F.max("fecha_venta").alias("ultima_compra"))
    current = star.cliente.where("es_registro_actual").select(
        "cliente_key", "id_cliente", F.col("ciudad").alias("ciudad_actual"))
    if by_id:
        ids = star.cliente.select("cliente_key", "id_cliente")
        sums = (sums.join(ids, "cliente_key").groupBy("id_cliente").agg(
            F.sum("total_transacciones").alias("total_transacciones"),
            F.sum("monto_total").alias("monto_total"),
            F.min("primera_compra").alias("primera_compra"),
            F.max("ultima_compra").alias("ultima_compra")))
        joined = sums.join(current.drop("cliente_key"), "id_cliente")
    else:
        joined = sums.join(current, "cliente_key")
    # rank <= top directly above the window: each task forwards only its best rows
    best = (joined.withColumn("ranking", F.rank().over(Window.orderBy(F.col("monto_total").desc())))
            .where(F.col("ranking") <= top))
    return best.select(
        "ranking", "id_cliente", "ciudad_actual", "total_transacciones", "monto_total",
        average("monto_total", "total_transacciones").alias("ticket_promedio"),
        "primera_compra", "ultima_compra").orderBy("ranking", "id_cliente")


def monthly_trend(star: Star) -> DataFrame:
    """Month by month: sales, customers and the change from the previous month with sales."""
    fact = star.totals()
    months = (fact.groupBy(month_key(F.col("fecha_key")).alias("_ym"))
              .agg(sale_count(fact).alias("total_transacciones"),
                   F.sum("monto_total").alias("monto_total"),
                   F.count_distinct("cliente_key").alias("clientes_unicos")))
    names = star.lookup("fecha").groupBy(month_key(F.col("fecha_key")).alias("_ym")).agg(
        F.first("anio").alias("anio"), F.first("mes").alias("num_mes"),
        F.first("nombre_mes").alias("mes"))
    # one row per calendar month
    in_order = Window.orderBy("anio", "num_mes")
    previous = F.lag("monto_total").over(in_order)
    return (months.join(names, "_ym").withColumn("_prev", previous)
            .select("anio", "num_mes", "mes", "total_transacciones", "monto_total",
                    average("monto_total", "total_transacciones").alias("ticket_promedio"),
                    "clientes_unicos",
                    F.coalesce("_prev", F.lit(0)).alias("monto_mes_anterior"),
                    F.coalesce(pct_change(F.col("monto_total"), F.col("_prev")),
                               F.lit(0.0)).alias("variacion_pct"))
            .orderBy("anio", "num_mes"))


def city_analysis(star: Star) -> DataFrame:
    fact = star.totals("ciudad")
    sums = fact.groupBy("ciudad_key").agg(
        sale_count(fact).alias("total_transacciones"), F.sum("monto_total").alias("monto_total"),
        F.count_distinct("cliente_key").alias("clientes_unicos"),
        F.sum("cantidad").alias("unidades_vendidas"))
    cities = sums.join(star.lookup("ciudad"), "ciudad_key")
    bound = star.bound("ciudad")
    ranked = with_rank(cities, "monto_total", "ranking_nacional", bound=bound)
    ranked = with_rank(ranked, "monto_total", "ranking_regional", by=["region"], bound=bound)
    ranked = with_total(ranked, "monto_total", "_all", bound)
    return ranked.select(
        "ranking_nacional", "nombre_ciudad", "departamento", "region", "ranking_regional",
        "total_transacciones", "monto_total",
        average("monto_total", "total_transacciones").alias("promedio_por_transaccion"),
        "clientes_unicos", "unidades_vendidas",
        share_pct(F.col("monto_total"), F.col("_all")).alias("participacion_pct"),
    ).orderBy("ranking_nacional", "nombre_ciudad")


def with_total(df: DataFrame, value: str, out: str, bound: DataFrame) -> DataFrame:
    """Add the grand total: a window when small, else a scalar subquery."""
    if is_small(bound):
        return df.withColumn(out, F.sum(value).over(Window.partitionBy()))
    return df.withColumn(out, df.agg(F.sum(value)).scalar())


def seller_ranking(star: Star) -> DataFrame:
    """Sellers by amount with a tercile label; sales without a seller stay out."""
    fact = star.sales()
    sums = fact.groupBy("vendedor_key").agg(
        sale_count(fact).alias("total_transacciones"), F.sum("monto_total").alias("monto_total"),
        F.sum("cantidad").alias("unidades_vendidas"),
        F.count_distinct("cliente_key").alias("clientes_atendidos"),
        F.min("fecha_venta").alias("primera_venta"), F.max("fecha_venta").alias("ultima_venta"))
    sellers = sums.join(star.lookup("vendedor").where(F.col("nombre_vendedor") != UNASSIGNED),
                        "vendedor_key")
    bound = star.bound("vendedor")
    ranked = with_rank(sellers, "monto_total", "ranking", bound=bound)
    ranked = with_ntile(ranked, 3, "monto_total", "vendedor_key", "_tile", bound=bound)
    return ranked.select(
        "ranking", "nombre_vendedor", "region", "ciudad_base", "total_transacciones", "monto_total",
        average("monto_total", "total_transacciones").alias("ticket_promedio"),
        "unidades_vendidas", "clientes_atendidos", "primera_venta", "ultima_venta",
        tercile_label(F.col("_tile")).alias("nivel_desempeño")).orderBy("ranking", "nombre_vendedor")


def product_analysis(star: Star) -> DataFrame:
    fact = star.sales()
    sums = fact.groupBy("producto_key").agg(
        sale_count(fact).alias("total_transacciones"), F.sum("cantidad").alias("total_unidades"),
        F.sum("monto_total").alias("monto_total"), F.sum("precio_unitario").alias("_precios"),
        F.count_distinct("cliente_key").alias("clientes_distintos"))
    products = sums.join(star.lookup("producto"), "producto_key")
    bound = star.bound("producto")
    ranked = with_rank(products, "total_unidades", "rank_por_unidades", bound=bound)
    ranked = with_rank(ranked, "monto_total", "rank_por_monto", bound=bound)
    return ranked.select(
        "id_producto", "nombre_producto", "categoria", "subcategoria", "total_transacciones",
        "total_unidades", "monto_total",
        average("_precios", "total_transacciones").alias("precio_promedio_venta"),
        "precio_referencia", "clientes_distintos", "rank_por_unidades", "rank_por_monto",
        (F.col("rank_por_monto") - F.col("rank_por_unidades")).alias("diferencia_rankings"),
    ).orderBy("rank_por_monto", "id_producto")


def channel_analysis(star: Star) -> DataFrame:
    """Channels with shares and commission, from one pass over the sales.

    Sales are summed per channel and customer, and per channel and product, in
    one aggregate over two rows a sale; distinct members are then its rows, and
    the amounts are those of the customers.
    """
    fact = star.sales()
    count = F.col("n_ventas") if "n_ventas" in fact.columns else F.lit(1)
    cells = fact.select("canal_key", count.alias("n"), "monto_total", "cantidad", "cliente_key", "producto_key").unpivot(
        ["canal_key", "n", "monto_total", "cantidad"], ["cliente_key", "producto_key"], "de", "miembro")
    members = cells.groupBy("canal_key", "de", "miembro").agg(
        F.sum("n").alias("n"), F.sum("monto_total").alias("m"), F.sum("cantidad").alias("u"))
    of_customers, present = F.col("de") == "cliente_key", F.col("miembro").isNotNull()
    whole = lambda value: F.sum(F.when(of_customers, F.col(value)))
    sums = members.groupBy("canal_key").agg(
        whole("n").alias("total_transacciones"), whole("m").alias("monto_total"), whole("u").alias("total_unidades"),
        F.count_if(of_customers & present).alias("clientes_unicos"),
        F.count_if(~of_customers & present).alias("productos_distintos"))
    channels = sums.join(star.lookup("canal"), "canal_key")
    bound = star.bound("canal")
    ranked = with_rank(channels, "monto_total", "ranking", bound=bound)
    ranked = with_total(ranked, "monto_total", "_all", bound)
    ranked = with_total(ranked, "total_transacciones", "_all_n", bound)
    amount, pct = F.col("monto_total").cast("double"), F.col("comision_pct").cast("double")
    return ranked.select(
        "ranking", "nombre_canal", "tipo_canal", "total_transacciones", "monto_total",
        average("monto_total", "total_transacciones").alias("ticket_promedio"),
        "total_unidades", share_pct(F.col("monto_total"), F.col("_all")).alias("participacion_pct"),
        share_pct(F.col("total_transacciones"), F.col("_all_n")).alias("participacion_transacciones_pct"),
        "clientes_unicos", "productos_distintos",
        F.round(amount * pct / 100.0, 0).alias("costo_comision"),
        F.round(amount * (1 - pct / 100.0), 0).alias("monto_neto_canal"),
    ).orderBy("ranking", "nombre_canal")


def product_yoy(star: Star) -> DataFrame:
    """Year over year by product, against the previous year with sales."""
    fact = star.sales()
    years = fact.groupBy("producto_key", F.floor(F.col("fecha_key") / 10000).cast("int").alias("anio")).agg(
        sale_count(fact).alias("total_transacciones"), F.sum("cantidad").alias("total_unidades"),
        F.sum("monto_total").alias("monto_total"), F.sum("precio_unitario").alias("_precios"))
    per_product = Window.partitionBy("producto_key").orderBy("anio")
    old = F.col("_old")
    grown = (years.withColumn("_old", F.lag("monto_total").over(per_product))
             .withColumn("_old_units", F.lag("total_unidades").over(per_product)))
    return grown.join(star.lookup("producto"), "producto_key").select(
        "id_producto", "nombre_producto", "categoria", "anio", "total_transacciones",
        "total_unidades", "monto_total",
        average("_precios", "total_transacciones").alias("precio_promedio"),
        F.coalesce("_old", F.lit(0)).alias("monto_anio_anterior"),
        F.col("_old_units").alias("unidades_anio_anterior"),
        F.when(old != 0, pct_change(F.col("monto_total"), old)).alias("yoy_growth_pct"),
        growth_label(F.col("monto_total"), old).alias("tendencia")).orderBy("id_producto", "anio")


def sales_view(star: Star) -> DataFrame:
    """One wide row per sale: the fact with the attributes of all six dimensions."""
    f = star.fact
    fecha = star.lookup("fecha").select("fecha_key", "fecha", "anio", "nombre_mes", "trimestre",
                                        "es_festivo")
    cliente = star.lookup("cliente").select("cliente_key", "id_cliente",
                                            F.col("ciudad").alias("ciudad_cliente"))
    producto = star.lookup("producto").select("producto_key", "nombre_producto", "categoria",
                                              "subcategoria")
    vendedor = star.lookup("vendedor").select("vendedor_key", "nombre_vendedor",
                                              F.col("region").alias("region_vendedor"))
    canal = star.lookup("canal").select("canal_key", "nombre_canal")
    ciudad = star.lookup("ciudad").select(
        "ciudad_key", F.col("nombre_ciudad").alias("ciudad_venta"), "departamento",
        F.col("region").alias("region_ciudad"))
    wide = (f.join(fecha, "fecha_key").join(canal, "canal_key").join(ciudad, "ciudad_key")
            .join(vendedor, "vendedor_key").join(producto, "producto_key").join(cliente, "cliente_key"))
    return wide.select(
        "id_venta", "fecha", "anio", "nombre_mes", "trimestre", "es_festivo", "id_cliente",
        "ciudad_cliente", "nombre_producto", "categoria", "subcategoria", "nombre_vendedor",
        "region_vendedor", "nombre_canal", "ciudad_venta", "departamento", "region_ciudad",
        "cantidad", "precio_unitario", "monto_total", "descuento", "impuestos", "monto_neto",
        "id_batch")


def rolled_up(sales: DataFrame, key: str, members: DataFrame, levels: list[str]) -> DataFrame:
    """Totals of every level of a hierarchy, from its top to its leaves, and of all.

    The sales are summed per key first, so only members are rolled up.
    ``nivel`` is the number of levels left out (0: the leaf), which tells a
    subtotal from a member whose name is missing.
    """
    sums = sales.groupBy(key).agg(sale_count(sales).alias("n"), F.sum("monto_total").alias("m"), F.sum("cantidad").alias("u"))
    rolled = sums.join(members, key, "left").rollup(*levels).agg(
        F.bit_count(F.grouping_id()).alias("nivel"), F.sum("n").alias("total_transacciones"), F.sum("m").alias("monto_total"),
        F.sum("u").alias("total_unidades"))
    return rolled.select(*levels, "nivel", "total_transacciones", "monto_total", "total_unidades")


def city_rollup(star: Star) -> DataFrame:
    """Sales by region, department and city, with all subtotals."""
    return rolled_up(star.totals("ciudad"), "ciudad_key", star.lookup("ciudad"), ["region", "departamento", "nombre_ciudad"])


def product_rollup(star: Star) -> DataFrame:
    """Sales by category and subcategory, with all subtotals."""
    return rolled_up(star.lines(), "producto_key", star.producto, ["categoria", "subcategoria"])
